"""Token ids of documents in files of patched frame-of-reference blocks.

Documents are encoded, dealt by ranges of the id, and written as files that any reader can open: within
a file, and from file to file, documents go by ascending id.  A file is

    magic        8 bytes, MILLTOK1
    header       part, number (32 bits), documents, ids, blocks, ids a block (64 bits), big-endian
    block starts one 64-bit place in the file a block, and the end of the last, big-endian
    blocks       minimum (32 bits), width (8), exceptions (16), little-endian; then the differences to the
                 minimum in width bits each, filled up to a byte; then the places (16) and the differences (32)
                 of the exceptions, those too large for the width
    documents    an Arrow stream of (id, n_tokens)
    end          one line feed

The width of a block is what a percentile of its differences needs, so that a few rare ids do not widen
all others.  ``index`` beside the files tells the ids before each file; with the block starts any stretch
of the whole sequence is read from the few blocks that hold it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import narrow
from millrace.llm.periodic_runs import slices, split_texts
from millrace.session import materialise, ship_package

MAGIC = b"MILLTOK1"
HEADER = struct.Struct(">8sIIQQQQ")
BLOCK = struct.Struct("<IBH")
#: What could match white space in a pattern, but for classes that begin with its negation.
MAY_BE_BLANK = re.compile(r"[. \t\n]|\[\^|\\[snrtvfWDPhHRXNQpb](?!\{[LN]\})")
#: Fixed value: the pattern of public tokenizers that take runs of letters, single digits and runs of signs for pieces.
LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Code points up to here are looked at one by one; all others make a word one piece.  U+00C0 to it have two bytes each.
LAST_LATIN = 0x17F
BLANK, LETTER, DIGIT, SIGN, OTHER = range(5)
#: Ids a block, the share of them that the width must hold, and ids a file if no document is longer.
BLOCK_IDS, PERCENTILE, FILE_IDS = 1024, 0.98, 2 << 20
#: Bytes of text encoded in one go, and words whose ids a worker remembers.
SLICE_BYTES, KNOWN_WORDS = 4 << 20, 1 << 20


# Blocks

def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of numbers as rows of bytes, ``width`` bits a number, the highest bit first."""
    size = 16 if width <= 16 else 32
    spread = np.unpackbits(values.astype(f">u{size // 8}").view(np.uint8).reshape(len(values), -1, size // 8), axis=2)
    return np.packbits(spread[:, :, size - width:].reshape(len(values), -1), axis=1)


def _numbers(rows: np.ndarray, width: int, count: int) -> np.ndarray:
    """Eight numbers have ``width`` bytes together; each is cut out of the five bytes at most that hold some of its bits."""
    groups = -(-count // 8)
    data = np.zeros((len(rows), groups * width), dtype=np.uint8)
    data[:, :rows.shape[1]] = rows
    data = data.reshape(len(rows), groups, width)
    out = np.empty((len(rows), groups, 8), dtype=np.uint32)
    for at in range(8):
        first, last = at * width // 8, ((at + 1) * width - 1) // 8
        value = data[:, :, first].astype(np.uint64)
        for byte in range(first + 1, last + 1):
            value = value << np.uint64(8) | data[:, :, byte]
        out[:, :, at] = value >> np.uint64(8 * (last + 1) - (at + 1) * width) & np.uint64((1 << width) - 1)
    return out.reshape(len(rows), -1)[:, :count]


def pack_ids(ids: np.ndarray, block_ids: int = BLOCK_IDS, percentile: float = PERCENTILE) -> list[bytes]:
    """The blocks of a sequence of 32-bit ids; only the last may be shorter than ``block_ids``."""
    if not 0 < percentile <= 1 or not 0 < block_ids <= 1 << 16:
        raise ValueError("percentile must be in (0, 1], a block may hold up to 65536 ids")
    out: list[bytes] = []
    whole, step = len(ids) // block_ids, max(1, (1 << 18) // block_ids)
    pieces = [ids[at * block_ids:min(at + step, whole) * block_ids].reshape(-1, block_ids) for at in range(0, whole, step)]
    if len(ids) > whole * block_ids:
        pieces.append(ids[whole * block_ids:].reshape(1, -1))
    for piece in pieces:
        least = piece.min(axis=1)
        over = (piece - least[:, None]).astype(np.uint32)
        place = int(np.ceil(percentile * piece.shape[1])) - 1
        widths = np.frexp(np.partition(over, place, axis=1)[:, place].astype(np.float64))[1]
        made: list[bytes] = [b""] * len(piece)
        for width in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == width)
            packed = _bits(over[rows] & np.uint32((1 << width) - 1), width) if width else np.zeros((len(rows), 0), dtype=np.uint8)
            for row, data in zip(rows.tolist(), packed):
                odd = np.flatnonzero(over[row] >= 1 << width) if width < 32 else np.zeros(0, dtype=np.int64)
                made[row] = (BLOCK.pack(int(least[row]), width, len(odd)) + data.tobytes()
                             + odd.astype("<u2").tobytes() + over[row][odd].astype("<u4").tobytes())
        out += made
    return out


def unpack_ids(blocks: list[bytes], counts: list[int]) -> np.ndarray:
    """The ids of blocks that hold ``counts`` ids."""
    ids = np.zeros(sum(counts), dtype=np.uint32)
    firsts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    alike: dict[tuple[int, int], list[int]] = {}
    heads = [BLOCK.unpack_from(block) for block in blocks]
    for at, (head, count) in enumerate(zip(heads, counts)):
        alike.setdefault((head[1], count), []).append(at)
    for (width, count), members in alike.items():
        size = (count * width + 7) // 8
        for begin in range(0, len(members), 256):
            some = members[begin:begin + 256]
            if width:
                rows = np.frombuffer(b"".join(blocks[at][BLOCK.size:BLOCK.size + size] for at in some), dtype=np.uint8).reshape(len(some), size)
                values = _numbers(rows, width, count)
            else:
                values = np.zeros((len(some), count), dtype=np.uint32)
            for at, row in zip(some, values):
                least, _, odd = heads[at]
                if odd:
                    end = BLOCK.size + size + 2 * odd
                    row[np.frombuffer(blocks[at][BLOCK.size + size:end], dtype="<u2")] = np.frombuffer(blocks[at][end:end + 4 * odd], dtype="<u4")
                ids[firsts[at]:firsts[at + 1]] = row + np.uint32(least)
    return ids


# Files

def make_file(part: int, number: int, ids: np.ndarray, docs: pa.RecordBatch, block_ids: int = BLOCK_IDS, percentile: float = PERCENTILE) -> bytes:
    """A file without its line feed.  ``docs`` has the columns id and n_tokens."""
    blocks = pack_ids(ids, block_ids, percentile)
    begin = HEADER.size + 8 * (len(blocks) + 1)
    starts = begin + np.concatenate([[0], np.cumsum([len(block) for block in blocks], dtype=np.int64)])
    listed = pa.BufferOutputStream()
    with pa.ipc.new_stream(listed, docs.schema) as stream:
        stream.write_batch(docs)
    return b"".join([HEADER.pack(MAGIC, part, number, docs.num_rows, len(ids), len(blocks), block_ids),
                     starts.astype(">u8").tobytes(), *blocks, listed.getvalue().to_pybytes()])


class TokenFile:
    """A file's content, opened without decoding anything."""

    def __init__(self, content: bytes) -> None:
        magic, self.part, self.number, self.n_docs, self.n_ids, n_blocks, self.block_ids = HEADER.unpack_from(content)
        if magic != MAGIC or content[-1:] != b"\n":
            raise ValueError("not a whole file of token ids")
        self.content = content
        self.starts = np.frombuffer(content, dtype=">u8", count=n_blocks + 1, offset=HEADER.size).astype(np.int64)

    def docs(self) -> pa.Table:
        with pa.ipc.open_stream(pa.py_buffer(self.content[int(self.starts[-1]):-1])) as stream:
            return stream.read_all()

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The ids from ``begin`` to ``end`` of the file, from the blocks that hold them alone."""
        if not 0 <= begin <= end <= self.n_ids:
            raise ValueError(f"{begin} to {end} is not within {self.n_ids} ids")
        first, last = begin // self.block_ids, -(-end // self.block_ids)
        blocks = [self.content[a:b] for a, b in zip(self.starts[first:last].tolist(), self.starts[first + 1:last + 1].tolist())]
        counts = [min(self.block_ids, self.n_ids - at * self.block_ids) for at in range(first, last)]
        return unpack_ids(blocks, counts)[begin - first * self.block_ids:end - first * self.block_ids]


# Encoding

def parts_at_blanks(model: dict) -> bool:
    """Whether a tokenizer encodes a text as its blank-parted words one by one: white space is dropped
    by the first step of its pre-tokenizer, and the normalizer does nothing across it."""
    steps = model.get("normalizer") or {"type": "Sequence", "normalizers": []}
    steps = steps["normalizers"] if steps["type"] == "Sequence" else [steps]
    known = all(step["type"] in ("NFC", "NFD", "Lowercase") or step["type"] == "Replace" and step["pattern"] == {"Regex": "\\s+"} and step["content"] == " " for step in steps)
    first = model.get("pre_tokenizer") or {"type": None}
    if first["type"] == "Sequence":
        first = first["pretokenizers"][0]
    keeps = first["pattern"].get("Regex") if first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"] else None
    drops = first["type"] == "WhitespaceSplit" or keeps is not None and not MAY_BE_BLANK.search(re.sub(r"\[\^\\s[^\]]*\]", "", keeps))
    strict = all(not token["lstrip"] and not token["rstrip"] and not set(token["content"]) & set(" \t\n\v\f\r") for token in model["added_tokens"])
    return known and drops and strict and not model.get("post_processor") and not model.get("truncation")


def letters_apart(model: dict) -> bool:
    """Whether a tokenizer that parts at blanks takes a run of letters, a digit, and a run of other
    ASCII characters without an apostrophe for one piece each, and leaves their characters as they are."""
    steps = (model.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return len(steps) == 2 and steps[0].get("pattern") == {"Regex": LETTER_RUNS} and steps[1]["type"] == "ByteLevel" \
        and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]


def kinds_of_characters(special: str, composed: bool) -> np.ndarray:
    """The kind of each code point up to ``LAST_LATIN`` for a tokenizer with ``letters_apart``; ``special`` are characters
    that added tokens begin with.  Letters beyond ASCII count if they stay ``composed``: each is whole in NFC and, but
    for U+0130, one letter in lower case."""
    kinds = np.full(LAST_LATIN + 1, OTHER, dtype=np.uint8)
    kinds[0x21:0x7F] = SIGN
    for code in [*range(0x7F), *(range(0xC0, LAST_LATIN + 1) if composed else [])]:
        if chr(code).isalpha() and len(chr(code).lower()) == 1:
            kinds[code] = LETTER
    kinds[ord("0"):ord("9") + 1], kinds[ord("'")] = DIGIT, OTHER
    kinds[[ord(one) for one in special if ord(one) <= LAST_LATIN]] = OTHER
    kinds[[ord(one) for one in " \t\n\v\f\r"]] = BLANK
    return kinds


def split_pieces(texts: pa.Array, kinds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """As ``split_texts``, but words of letters, digits and signs alone are in lower case and parted in runs of letters,
    single digits and runs of signs."""
    texts = texts.fill_null("").cast(pa.string())
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    bounds -= bounds[0]
    if not len(raw):
        return pa.array([], pa.string()), np.zeros(len(bounds), dtype=np.int64)
    lower = np.array([ord(chr(code).lower()) if kind == LETTER else code for code, kind in enumerate(kinds.tolist())], dtype=np.uint16)
    by_byte, small = np.full(256, OTHER, dtype=np.uint8), np.arange(256, dtype=np.uint8)
    by_byte[:128], small[:128] = kinds[:128], lower[:128]
    kind, made = by_byte[raw], small[raw]
    lead = np.flatnonzero((raw[:-1] >= 0xC3) & (raw[:-1] <= 0xC0 | LAST_LATIN >> 6) & (raw[1:] & 0xC0 == 0x80))
    code = (raw[lead].astype(np.uint16) & 0x1F) << 6 | raw[lead + 1] & 0x3F
    kind[lead] = kind[lead + 1] = kinds[code]
    made[lead], made[lead + 1] = 0xC0 | lower[code] >> 6, 0x80 | lower[code] & 0x3F

    solid = kind != BLANK
    word = solid.copy()  # whether a word begins here
    word[1:] &= ~solid[:-1]
    inner = bounds[:-1][bounds[:-1] < len(raw)]
    word[inner] = solid[inner]
    kind, made, raw, word, before = kind[solid], made[solid], raw[solid], word[solid], np.cumsum(solid, dtype=np.int32)
    # From here on without blanks: words of other characters are as they were, and one piece.
    firsts = np.flatnonzero(word)
    if not len(firsts):
        return pa.array([], pa.string()), np.zeros(len(bounds), dtype=np.int64)
    whole = np.maximum.reduceat(kind, firsts) == OTHER
    begins = kind == DIGIT
    begins[1:] |= kind[1:] != kind[:-1]
    if whole.any():
        kept = np.repeat(whole, np.diff(np.append(firsts, len(raw))))
        made = np.where(kept, raw, made)
        begins &= ~kept
    begins |= word
    starts = np.append(np.flatnonzero(begins), len(raw)).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(made))
    return pieces, np.searchsorted(starts[:-1], np.where(bounds > 0, before[bounds - 1], 0))


class Encoder:
    """A tokenizer that remembers words, where words are all that counts.  What it remembers never changes a result."""

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        model = json.loads(definition)
        self.tokenizer = Tokenizer.from_str(definition)
        self.by_words = parts_at_blanks(model)
        steps = (model.get("normalizer") or {}).get("normalizers", [model.get("normalizer") or {}])
        steps = {step.get("type") for step in steps}
        self.pieces = "Lowercase" in steps and self.by_words and letters_apart(model)
        # Special tokens are looked for before anything else, so words that may hold one are not touched.
        self.kinds = kinds_of_characters("".join({token["content"][0] for token in model["added_tokens"]}), "NFD" not in steps)
        letters = [chr(code) for code in np.flatnonzero(self.kinds == LETTER).tolist() if chr(code).lower() == chr(code)]
        self.letters = re.compile("[" + re.escape("".join(letters)) + "]+")
        alphabet = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelt = {ord(one): alphabet.pre_tokenize_str(one)[0][0] for one in letters}
        self._forget()

    def _forget(self) -> None:
        """Word k of those known has the ids from place k to place k + 1."""
        self.known: dict[str, int] = {}
        self.ids, self.places = array("I"), array("q", [0])

    def _batch(self, texts: list[str]) -> Iterator[list[int]]:
        for at in range(0, len(texts), 1024):
            for found in self.tokenizer.encode_batch_fast(texts[at:at + 1024], add_special_tokens=False):
                yield found.ids

    def _learn(self, words: list[str]) -> None:
        """Add new words, in their order; runs of plain letters go to the model as they are."""
        letters = self.letters.fullmatch
        direct = [self.pieces and letters(word) is not None for word in words]
        rest = self._batch([word for word, one in zip(words, direct) if not one])
        tokenize, ids, places = self.tokenizer.model.tokenize, self.ids, self.places
        for word, one in zip(words, direct):
            if one:
                ids.extend([token.id for token in tokenize(word if word.isascii() else word.translate(self.spelt))])
            else:
                ids.extend(next(rest))
            places.append(len(ids))
        self.known.update(zip(words, range(len(self.known), len(places) - 1)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of each."""
        if not self.by_words:
            each = [np.array(ids, dtype=np.uint32) for ids in self._batch(texts.fill_null("").to_pylist())]
            return np.concatenate([np.zeros(0, dtype=np.uint32), *each]), np.array([len(ids) for ids in each], dtype=np.int64)
        words, firsts = split_pieces(texts, self.kinds) if self.pieces else split_texts(texts)
        coded = words.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False)
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        numbers = np.fromiter(map(self.known.get, different, repeat(-1)), dtype=np.int64, count=len(different))
        new = np.flatnonzero(numbers < 0)
        numbers[new] = np.arange(len(self.known), len(self.known) + len(new))
        self._learn(different[new].tolist())
        # First the ids of the different words, in a small table, then those of all words from there.
        places = np.frombuffer(self.places, dtype=np.int64)
        flat, ends = _gather(np.frombuffer(self.ids, dtype=np.uint32), places[numbers], places[numbers + 1])
        at = coded.indices.to_numpy()
        ids, after = _gather(flat, np.concatenate([[0], ends])[at], ends[at])
        return ids, np.diff(np.concatenate([[0], after])[firsts])


def _gather(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``values``, one after the other, and where each ends there."""
    own = ends - begins
    after = np.cumsum(own)
    places = np.repeat(begins - (after - own), own)
    places += np.arange(len(places))
    return values[places], after


_ENCODERS: dict[str, Encoder] = {}


def encoder(definition: str) -> Encoder:
    """One encoder a worker and definition."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(definition)
    return _ENCODERS[key]


# The operator

def write_tokens(docs: DataFrame, path: str, definition: str, end_id: int | None = None, id_column: str = "doc_id", text_column: str = "text",
                 block_ids: int = BLOCK_IDS, percentile: float = PERCENTILE, file_ids: int = FILE_IDS,
                 slice_bytes: int = SLICE_BYTES) -> None:
    """Encode all documents and write them below ``path``: ``data``, the files, and ``index``, a Parquet
    table (file, part, number, n_docs, n_ids, first_id) with a row a file.

    ``definition`` is the tokenizer's JSON text.  ``end_id``, if any, follows each document.  Documents go by
    id, null first, equal ids by a hash of their texts; rows that are equal in both are alike.  A null or empty
    text has no ids but the end.  An empty table gives no file and an empty index; further columns are
    not read.  A document lies in one file, whatever its length (up to 500 million ids).

    Texts are dealt by ranges and encoded where their files are written, so that they cross the network once and
    nothing is stored on the way.  The ranges are cut by id, hash and row: a third of all rows under one
    id, or with one text, is shared among tasks.
    """
    spark = docs.sparkSession
    ship_package(spark)
    order = [F.col("_id"), F.col("_tie"), F.col("_row")]
    chosen = narrow(docs, id_column, text_column).toDF("_id", "_text")
    dealt = chosen.withColumns({"_tie": F.xxhash64("_text"), "_row": F.monotonically_increasing_id()}).repartitionByRange(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part, number = encoder(definition), TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def file() -> pa.RecordBatch:
            listed = pa.record_batch([pa.concat_arrays([keys for keys, _, _ in held]), pa.array(np.concatenate([counts for _, counts, _ in held]), pa.int64())], ["id", "n_tokens"])
            ids = np.concatenate([ids for _, _, ids in held])
            held.clear()
            made = make_file(part, number, ids, listed, block_ids, percentile)
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["value"])

        size = 0
        for batch in batches:
            texts = batch.column(1)
            for begin, end in slices(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).tolist(), slice_bytes):
                ids, counts = tool.encode(texts.slice(begin, end - begin))
                if end_id is not None:
                    ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
                ids, ends, keys = ids.astype(np.uint32), np.cumsum(counts), batch.column(0).slice(begin, end - begin)
                for low, high in slices(counts.tolist(), file_ids):
                    stretch = ids[ends[low] - counts[low]:ends[high - 1]]
                    if held and size + len(stretch) > file_ids:
                        yield file()
                        number, size = number + 1, 0
                    # A copy, where a view would hold all ids of its slice.
                    held.append((keys.slice(low, high - low), counts[low:high], stretch.copy()))
                    size += len(stretch)
        if held:
            yield file()

    files = dealt.sortWithinPartitions(*order).select("_id", "_text").mapInArrow(pack, "value binary")
    # One row is one file: Spark's text sink writes its bytes and a line feed, wherever the path is.
    files.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(f"{path}/data")
    write_index(spark, path)


def _open(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{path}/data")


def write_index(spark: SparkSession, path: str) -> None:
    """Store the ids before each file, from the headers: sums over the parts, then within each part."""
    def number(begin: int, size: int):
        return F.conv(F.hex(F.expr(f"substring(content, {begin + 1}, {size})")), 16, 10).cast("long")

    files = materialise(_open(spark, path).filter("length > 1").select(
        F.element_at(F.split("path", "/"), -1).alias("file"), number(8, 4).alias("part"), number(12, 4).alias("number"), number(16, 8).alias("n_docs"), number(24, 8).alias("n_ids")), "token-files")
    # Rows: one a file within its part, one a part over all.
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("_ids")).select("part", F.coalesce(F.sum("_ids").over(over), F.lit(0)).alias("_before"))
    files.withColumn("_own", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(parts, "part").select(
        "file", "part", "number", "n_docs", "n_ids", (F.col("_before") + F.col("_own")).alias("first_id")).write.parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file string, part long, number long, n_docs long, n_ids long, first_id long").parquet(f"{path}/index")


def read_tokens(spark: SparkSession, path: str, id_type: str = "bigint", id_name: str = "doc_id", batch_ids: int = 1 << 21) -> DataFrame:
    """The documents of files: id, start (ids of all documents before), n_tokens, and ids as little-endian
    32-bit numbers."""
    ship_package(spark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                file = TokenFile(content.as_py())
                listed = file.docs()
                counts = listed.column("n_tokens").to_numpy().astype(np.int64)
                ends = np.cumsum(counts)
                for begin, end in slices(counts.tolist(), batch_ids):
                    base = int(ends[begin] - counts[begin])
                    data = file.ids(base, int(ends[end - 1])).astype("<u4").tobytes()
                    own = [data[4 * (b - n - base):4 * (b - base)] for b, n in zip(ends[begin:end].tolist(), counts[begin:end].tolist())]
                    rows = end - begin
                    yield pa.RecordBatch.from_arrays(
                        [listed.column("id").slice(begin, rows).combine_chunks(), pa.array(np.full(rows, file.part)), pa.array(np.full(rows, file.number)),
                         pa.array(ends[begin:end] - counts[begin:end]), pa.array(counts[begin:end]), pa.array(own, pa.binary())],
                        [id_name, "_part", "_number", "_at", "n_tokens", "ids"])

    found = _open(spark, path).filter("length > 1").select("content").mapInArrow(
        work, f"`{id_name}` {id_type}, _part long, _number long, _at long, n_tokens long, ids binary")
    index = read_index(spark, path).select(F.col("part").alias("_part"), F.col("number").alias("_number"), "first_id")
    return found.join(index, ["_part", "_number"]).select(f"`{id_name}`", (F.col("first_id") + F.col("_at")).alias("start"), "n_tokens", "ids")


def read_stretch(spark: SparkSession, path: str, begin: int, end: int) -> DataFrame:
    """The ids from ``begin`` to ``end`` of the whole sequence: (at, ids), a row a file, ids as little-endian 32-bit numbers.

    Only files that hold some of them are opened, as the index tells, and of these only the blocks decoded.  The names of
    these files come to the driver: they are as many as the stretch is long.
    """
    ship_package(spark)
    wanted = read_index(spark, path).filter((F.col("first_id") < end) & (F.col("first_id") + F.col("n_ids") > begin)).select("file", "first_id").collect()
    if begin >= end or not wanted:
        return spark.createDataFrame([], "at long, ids binary")
    firsts = {row.file: row.first_id for row in wanted}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                file, first = TokenFile(content.as_py()), firsts[name.rsplit("/", 1)[1]]
                low, high = max(begin - first, 0), min(end - first, file.n_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first + low]), pa.array([file.ids(low, high).astype("<u4").tobytes()], pa.binary())], ["at", "ids"])

    files = spark.read.format("binaryFile").load([f"{path}/data/{name}" for name in firsts])
    return files.select("path", "content").mapInArrow(work, "at long, ids binary")
