from __future__ import annotations

import os
import shutil
from collections import Counter

import pytest

from millrace.operators import counting
from millrace.operators.counting import merge_counts
from millrace.streaming.counting import (
    BatchStore, _latest, count_arriving, counts_so_far, running_counts, stream_word_count, text_stream,
)

FILES = ["red blue red", "blue", "", "green red\nred", "blue green", "red"]


def write(folder, first, texts):
    for i, words in enumerate(texts):
        (folder / f"{first + i:03d}.txt").write_text(words)
        os.utime(folder / f"{first + i:03d}.txt", (1_700_000_000 + first + i,) * 2)  # they arrive in order


def want(texts):
    return dict(Counter(w for t in texts for w in t.split()))


def as_dict(df):
    return {r.word: r.n for r in df.collect()}


@pytest.mark.parametrize("stateful", [False, True])
@pytest.mark.parametrize("files", [1, 4, 100])
def test_stream_equals_batch_for_any_batch_size(spark, tmp_path, files, stateful):
    write(tmp_path, 0, FILES)
    counts = stream_word_count(text_stream(spark, str(tmp_path), files), stateful=stateful)
    assert as_dict(counts) == want(FILES)
    assert counting.top_words(counts, 1).first().word == "red"
    assert counting.checksum(counts).first().checksum == sum(len(w) * n for w, n in want(FILES).items())


@pytest.mark.parametrize("run", [
    lambda s, a, b: (count_arriving(s, a, b), counts_so_far(s.sparkSession, a))[1], running_counts,
])
def test_later_files_are_added_on_the_next_call(spark, tmp_path, run):
    source = tmp_path / "in"
    source.mkdir()
    folders = str(tmp_path / "store"), str(tmp_path / "checkpoint")
    write(source, 0, FILES[:2])
    assert as_dict(run(text_stream(spark, str(source), 1), *folders)) == want(FILES[:2])
    write(source, 2, FILES[2:])
    assert as_dict(run(text_stream(spark, str(source), 1), *folders)) == want(FILES)


def numbers(folder, kind):
    return sorted(int(name.split("=")[1]) for name in os.listdir(folder) if name.startswith(f"{kind}="))


@pytest.mark.parametrize("stateful", [False, True])
def test_batches_are_compacted(spark, tmp_path, stateful):
    """Twenty batches read as one snapshot and the few after it; what a snapshot replaced stays for one more."""
    source, store = tmp_path / "in", str(tmp_path / "store")
    source.mkdir()
    write(source, 0, FILES * 3 + FILES[:2])
    run = running_counts if stateful else count_arriving
    run(text_stream(spark, str(source), 1), store, str(tmp_path / "checkpoint"), every=3)
    kept = BatchStore(spark, store, _latest if stateful else merge_counts, 3)
    assert [folder.rsplit("/", 1)[1] for folder in kept.folders()] == ["snapshot=17", "batch=18", "batch=19"]
    assert numbers(store, "snapshot") == [14, 17] and numbers(store, "batch") == [15, 16, 17, 18, 19]
    assert as_dict(kept.read()) == want(FILES * 3 + FILES[:2])


@pytest.mark.parametrize("stateful", [False, True])
@pytest.mark.parametrize("fails", ["before the write", "in the write", "after the write", "after the snapshot"])
def test_a_failed_batch_counts_once_after_a_restart(spark, tmp_path, monkeypatch, stateful, fails):
    source, folders = tmp_path / "in", (str(tmp_path / "store"), str(tmp_path / "checkpoint"))
    source.mkdir()
    write(source, 0, FILES)
    run, add, keep = (running_counts if stateful else count_arriving), BatchStore.add, BatchStore._write
    broken = []

    def failing_add(self, counts, number):
        if number == 2 and fails == "before the write":
            raise RuntimeError("lost")
        add(self, counts, number)
        if number == 2 and fails.startswith("after"):
            raise RuntimeError("lost")

    def failing_write(self, counts, kind, number):
        keep(self, counts, kind, number)
        if fails == "in the write" and kind == "batch" and number == 2 and not broken:
            broken.append(os.remove(f"{self.path}/batch=2/_SUCCESS"))
            raise RuntimeError("lost")

    monkeypatch.setattr(BatchStore, "add", failing_add)
    monkeypatch.setattr(BatchStore, "_write", failing_write)
    every = 3 if fails == "after the snapshot" else 100
    with pytest.raises(Exception, match="lost"):
        run(text_stream(spark, str(source), 1), *folders, every=every)
    kept = BatchStore(spark, folders[0], _latest if stateful else merge_counts, every)
    assert as_dict(kept.read()) == want(FILES[:3] if fails.startswith("after") else FILES[:2])
    monkeypatch.undo()
    run(text_stream(spark, str(source), 1), *folders, every=every)
    assert as_dict(kept.read()) == want(FILES)


def test_a_thousand_batches_read_as_few_folders(spark, tmp_path):
    kept = BatchStore(spark, str(tmp_path), merge_counts, 250)
    one = spark.createDataFrame([("red", 1)], "word string, n bigint").coalesce(1)
    one.write.parquet(f"{tmp_path}/first")
    for number in range(1000):  # as Spark leaves them, without running a job for each
        shutil.copytree(tmp_path / "first", tmp_path / f"batch={number}")
        if number % 250 == 249:
            kept.compact()
    kept.add(one, 1000)
    assert len(kept.folders()) == 2 and as_dict(kept.read()) == {"red": 1001}
    assert len(numbers(tmp_path, "batch")) == 251


def test_batches_bounded_by_bytes(spark, tmp_path):
    source, folders = tmp_path / "in", (str(tmp_path / "store"), str(tmp_path / "checkpoint"))
    source.mkdir()
    write(source, 0, ["w " * 50] * 12)
    count_arriving(text_stream(spark, str(source), bytes_per_batch=350), *folders)
    assert len(numbers(folders[0], "batch")) == 4 and as_dict(counts_so_far(spark, folders[0])) == {"w": 600}
    with pytest.raises(ValueError):
        text_stream(spark, str(source), bytes_per_batch=0)


def test_no_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert stream_word_count(text_stream(spark, str(tmp_path / "in"))).count() == 0


def test_hidden_names_are_an_error(spark, tmp_path):
    write(tmp_path, 0, FILES)
    (tmp_path / "_old").mkdir()
    for name in ("_b.txt", "_old/c.txt"):
        (tmp_path / name).write_text("red")
    with pytest.raises(ValueError, match="2 files have names"):
        text_stream(spark, str(tmp_path))
    assert as_dict(stream_word_count(text_stream(spark, str(tmp_path), 9, skip_hidden=True))) == want(FILES)


def test_batch_size_must_be_positive(spark, tmp_path):
    with pytest.raises(ValueError):
        text_stream(spark, str(tmp_path), 0)
