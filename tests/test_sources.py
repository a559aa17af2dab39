from __future__ import annotations

import time
from pathlib import Path
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from millrace.session import materialise, scratch_dir, spread
from millrace.sources import hidden, tables, text


def test_word_vectors_keep_odd_words_and_line_numbers(spark, tmp_path):
    (tmp_path / "v.txt").write_text('the 1 2.5\n"quote -1 0\n\nnull 0 0\nNA 1e-3 4\n')
    got = {r["id"]: (r["label"], r["vec"]) for r in text.read_word_vectors(spark, str(tmp_path)).collect()}
    assert [got[i][0] for i in range(4)] == ["the", '"quote', "null", "NA"]
    assert got[0][1] == [1.0, 2.5] and got[3][1] == pytest.approx([0.001, 4.0])


def test_line_numbers_over_files_and_splits(spark, tmp_path):
    lines = [f"line {i} {'x' * (i % 50)}" for i in range(5000)]
    for part in range(4):
        (tmp_path / f"part-{part}.txt").write_text("\n".join(lines[part * 1250:(part + 1) * 1250]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        frame = text.number_rows(spark, str(tmp_path))
        assert frame.rdd.getNumPartitions() >= 1
        got = {r.line: r.value for r in frame.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == dict(enumerate(lines))


@pytest.mark.parametrize("setting, called, computed", [
    ("spark.sql.leafNodeDefaultParallelism", "8", "16"), ("spark.sql.files.maxPartitionBytes", "9000", "4000")])
def test_no_line_is_lost_when_splits_change(spark, tmp_path, setting, called, computed):
    lines = [f"line {i} {'x' * (i % 50)}" for i in range(5000)]
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n")
    before = spark.conf.get(setting, None)
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        spark.conf.set(setting, called)
        frame = text.number_rows(spark, str(tmp_path))
        spark.conf.set(setting, computed)
        got = {r.line: r.value for r in frame.collect()}
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
    assert got == dict(enumerate(lines))


def test_numbered_lines_are_not_stored_and_belong_to_the_callers_session(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"{'x' * 90} {i}\n" for i in range(20_000)))
    from millrace import session
    handed = len(session._handed_out.get(spark.sparkContext.applicationId, []))
    frame = text.number_rows(spark, str(tmp_path / "a.txt"))
    assert frame.sparkSession is spark
    written = session._handed_out[spark.sparkContext.applicationId][handed:]
    size = sum(file.stat().st_size for folder in written for file in Path(folder).rglob("*") if file.is_file())
    assert len(written) == 1 and size < 20_000 < (tmp_path / "a.txt").stat().st_size
    frame.createOrReplaceTempView("numbered")
    assert spark.sql("SELECT count(*) AS n FROM numbered WHERE value LIKE concat('% ', line)").first().n == 20_000


HIDDEN = ("_b.txt", ".c.txt", "_old/d.txt", "_old/sub/_e [1].txt", "a/.f é.txt", "a/{x}/_g*.txt", "a/.h/i.txt")


@pytest.fixture
def tree(tmp_path):
    """Files with plain and hidden names, each with its own path as text, and some that are no text."""
    for name in ("top.txt", "a/b.txt", "a/{x}/c.txt", *HIDDEN, "_note.md", "a/_note.md", "_x.txt.d/plain.md", "_empty.txt/none.md"):
        file = tmp_path / "tree" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(f"{name}\nsecond")
    return tmp_path / "tree"


def below(tree, rows):
    return sorted((unquote(r.path).removeprefix(f"file:{tree}/"), r.text) for r in rows)


@pytest.mark.parametrize("whole", [False, True])
def test_hidden_names_are_read(spark, tree, whole):
    names = ["top.txt", "a/b.txt", "a/{x}/c.txt", *HIDDEN]
    want = sorted((name, text) for name in names for text in ([f"{name}\nsecond"] if whole else [name, "second"]))
    assert below(tree, text.read_corpus(spark, str(tree), whole).collect()) == want
    assert [name.removeprefix(f"file:{tree}/") for name in hidden.hidden_files(spark, f"{tree}/")] == sorted(HIDDEN)
    skipped = text.read_corpus(spark, str(tree), whole, skip_hidden=True).collect()
    assert {name for name, _ in below(tree, skipped)} == {"top.txt", "a/b.txt", "a/{x}/c.txt"}


@pytest.mark.parametrize("glob, names", [
    ("*", {"top.txt", "a/b.txt", "a/{x}/c.txt", *HIDDEN}), ("*/*", {"a/b.txt", "a/{x}/c.txt", *HIDDEN[2:]}),
    ("a", {"a/b.txt", "a/{x}/c.txt", *HIDDEN[4:]}), ("_old", {"_old/d.txt", "_old/sub/_e [1].txt"}), ("{_old,a}/*.txt", {"_old/d.txt", "a/b.txt", "a/.f é.txt"})])
def test_globs_lose_and_repeat_nothing(spark, tree, glob, names):
    got = below(tree, text.read_corpus(spark, f"{tree}/{glob}").collect())
    assert got == sorted((name, line) for name in names for line in (name, "second"))


def test_many_files_cost_no_call_each(spark, tmp_path):
    for folder in range(40):
        (tmp_path / f"f{folder}" / "_in").mkdir(parents=True)
        for i in range(50):
            (tmp_path / f"f{folder}" / f"{i}.txt").write_text("x")
            (tmp_path / f"f{folder}" / "_in" / f"{i}.txt").write_text("y")
    begin = time.perf_counter()
    found = hidden.hidden_files(spark, str(tmp_path))
    assert len(found) == 2000 and time.perf_counter() - begin < 5
    rows = text.read_corpus(spark, str(tmp_path)).groupBy("text").count().collect()
    assert sorted(map(tuple, rows)) == [("x", 2000), ("y", 2000)]


def test_a_large_hidden_file_is_split(spark, tmp_path):
    (tmp_path / "_large.txt").write_text("".join(f"line {i}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        lines = text.read_corpus(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 3 and lines.select("text").distinct().count() == lines.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_file_system_that_a_task_opens_anew_knows_the_mount(spark, tree):
    """As in an executor, which has no file system that the driver has opened."""
    spark.conf.set("fs.viewfs.impl.disable.cache", "true")
    try:
        got = below(tree, text.read_corpus(spark, str(tree)).collect())
    finally:
        spark.conf.unset("fs.viewfs.impl.disable.cache")
    assert got == sorted((name, line) for name in ("top.txt", "a/b.txt", "a/{x}/c.txt", *HIDDEN) for line in (name, "second"))


def test_csv_files_by_their_own_headers(spark, tmp_path):
    """Other orders and further columns, with a blank in a file name."""
    (tmp_path / "one file.csv").write_text('STATION,NAME,DATE,TMIN,TMAX\nA,"X, US",2000-01-01,1.0,2.0\n')
    (tmp_path / "b.csv").write_text('STATION,DATE,NAME,PRCP,TMAX,TMIN\nB,2000-01-02,Y,9,4.0,3.0\n')
    got = sorted((r.station, r["name"], str(r.date), r.tmin, r.tmax) for r in tables.read_climate(spark, str(tmp_path)).collect())
    assert got == [("A", "X, US", "2000-01-01", 1.0, 2.0), ("B", "Y", "2000-01-02", 3.0, 4.0)]
    points = tmp_path / "points"
    points.mkdir()
    (points / "a.csv").write_text("name,easting,northing\nA,1,2\n")
    (points / "b.csv").write_text("name,northing,easting\nB,4,3\n")
    assert sorted((r.label, r.vec) for r in tables.read_points(spark, str(points)).collect()) == [("A", [1.0, 2.0]), ("B", [3.0, 4.0])]
    (points / "c.csv").write_text("name,x,y\nC,5,6\n")
    with pytest.raises(Exception, match="easting"):
        tables.read_points(spark, str(points)).collect()


def test_csv_files_with_odd_names_and_lines(spark, tmp_path):
    names = ["a[1].csv", "b*.csv", "{c}.csv", "d?é.csv", "x/e.csv"]
    (tmp_path / "x").mkdir()
    want = []
    for i, name in enumerate(names):
        order = ["name", "easting", "northing", f"more{i}"][i % 3:] + ["name", "easting", "northing", f"more{i}"][:i % 3]
        value = {"name": f'"A ""q"", {i}"', "easting": str(i), "northing": "2.5", f"more{i}": '"x, y"'}
        short = {"name": f"B{i}", "easting": "7", "northing": "8", f"more{i}": ""}
        body = [order, [value[c] for c in order], [short[c] for c in order]]
        (tmp_path / name).write_text(("\ufeff" if i == 2 else "") + "\n\n".join(",".join(line) for line in body) + "\r\n" * (i == 1))
        want += [(f'A "q", {i}', [float(i), 2.5]), (f"B{i}", [7.0, 8.0])]
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "only.csv").write_text("easting,name,northing\n")
    for root in (f"{tmp_path}/*", f"{tmp_path}/*.csv"):
        rows = want if root.endswith("*") else want[:-2]
        assert sorted((r.label, r.vec) for r in tables.read_points(spark, root).collect()) == sorted(rows)


def test_absent_and_empty_fields_are_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text('STATION,NAME,DATE,TMIN,TMAX\nA,N,2000-01-01,"",\nB,N,2000-01-02\nC,N,2000-01-03,1,2,3,4\n')
    got = [(r.station, r.tmin, r.tmax) for r in tables.read_climate(spark, str(tmp_path)).orderBy("station").collect()]
    assert got == [("A", None, None), ("B", None, None), ("C", 1.0, 2.0)]
    kinds = dict(tables.read_climate(spark, str(tmp_path), infer=True).dtypes)
    assert kinds == {"station": "string", "name": "string", "date": "date", "tmin": "int", "tmax": "int"}


def test_large_files_are_read_once_and_their_first_block_twice(spark, tmp_path):
    """Splits beyond the first take their file's header, which one buffer of the file gives."""
    for i in range(3):
        order = ["northing", "more", "easting", "name"] if i % 2 else ["name", "easting", "northing"]
        lines = [",".join({"name": f'"n, {i} {k}"', "easting": str(k), "northing": str(i), "more": "-"}[c] for c in order) for k in range(60_000)]
        (tmp_path / f"p{i}.csv").write_text("\n".join([",".join(order), *lines]))
    before = {name: spark.conf.get(f"spark.sql.files.{name}") for name in ("maxPartitionBytes", "openCostInBytes")}
    for name, size in (("maxPartitionBytes", "200k"), ("openCostInBytes", "1k")):
        spark.conf.set(f"spark.sql.files.{name}", size)
    try:
        assert len(tables._first_lines(spark, str(tmp_path))) == 3
        points = tables.read_points(spark, str(tmp_path))
        assert points.rdd.getNumPartitions() > 10
        got = points.select("label", F.col("vec")[0].alias("e"), F.col("vec")[1].alias("n"))
        assert got.filter("label = concat('n, ', cast(n as int), ' ', cast(e as int))").count() == got.distinct().count() == 180_000
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "200k"
    finally:
        for name, size in before.items():
            spark.conf.set(f"spark.sql.files.{name}", size)


def test_query_list_and_matrix(spark, tmp_path):
    (tmp_path / "words.txt").write_text("priest\nfork\n\nhorse\n")
    got = {r.qid: r.label for r in text.read_query_list(spark, str(tmp_path / "words.txt")).collect()}
    assert got == {0: "priest", 1: "fork", 2: "", 3: "horse"}
    (tmp_path / "m.txt").write_text("1 2 3\n\n 4  5 6 \n")
    got = {r.qid: r.vec for r in text.read_query_matrix(spark, str(tmp_path / "m.txt")).collect()}
    assert got == {0: [1.0, 2.0, 3.0], 1: [4.0, 5.0, 6.0]}


def test_points(spark, tmp_path):
    (tmp_path / "p.csv").write_text('id,name,easting,northing\n1,"The Crown, York",4.5,9\n2,Anchor,1,2\n')
    got = [(r.label, r.vec) for r in tables.read_points(spark, str(tmp_path / "p.csv")).collect()]
    assert got == [("The Crown, York", [4.5, 9.0]), ("Anchor", [1.0, 2.0])]


class Settings:
    """Stands in for a session of a given master and checkpoint folder."""

    def __init__(self, master, folder):
        self.conf = {"spark.checkpoint.dir": folder}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"{master}-{folder}"})


def test_scratch_follows_the_cluster():
    assert scratch_dir(Settings("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/millrace/x-")
    with pytest.raises(ValueError, match="shared by all executors"):
        scratch_dir(Settings("yarn", None), "x")
    own = Settings("local[2]", None)
    first, second = scratch_dir(own, "x"), scratch_dir(own, "x")
    assert first != second and first.rsplit("/", 2)[0] == second.rsplit("/", 2)[0]


def test_stored_tables_read_back(spark):
    stored = materialise(spark.range(3), "numbers")
    assert sorted(row.id for row in stored.collect()) == [0, 1, 2]


def test_scratch_tables_can_be_removed(spark, tmp_path):
    other = spark.newSession()
    stored = materialise(other.range(3), "numbers")
    path = stored.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0].replace("//", "/")
    import os
    assert os.path.isdir(path)
    from millrace import session
    kept = session._handed_out.pop(spark.sparkContext.applicationId)
    session._handed_out[spark.sparkContext.applicationId] = kept[-1:]
    assert session.remove_scratch(spark) == 1 and not os.path.exists(path)
    session._handed_out[spark.sparkContext.applicationId] = kept[:-1]


def test_spread_only_touches_small_scans(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == cores
    assert spread(spark.range(0, 100, 1, 3 * cores)).rdd.getNumPartitions() == 3 * cores
