"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

Symbols are characters; a word that repeats the one before it is, with the space between, one
symbol of its own, so that stuttering is as surprising as odd characters.  Trigrams of symbols are counted once: each block of
documents keeps its documents' counts against its own vocabulary, in a written table.  From there

* the model: counts of the trusted documents are added up, and the lower orders and discounts
  follow from them by aggregation;
* the scores: each block asks for the trigrams that it holds; the asked ones are joined with the
  counts of all orders, dealt by language and gram; the answers go back to the block, which adds
  up its documents' log-probabilities.

So neither texts nor rows per character move.  A document is kept if its perplexity is at most the
quantile of the trusted documents of its language.  A few words foreign to trusted text, such as insults,
do not move the perplexity of a long document; its rarity, the perplexity of its rarest trigrams alone,
shows them, and is judged for itself by the same quantile.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import pack_bytes, unpack_bytes
from millrace.session import materialise, ship_package

#: Share of trusted documents of a language that are kept.
QUANTILE = 0.995
#: So many of the least probable trigrams of a document make its rarity.
RAREST = 8
#: Text of a block, in characters.
BLOCK_CHARACTERS = 2 << 20
#: Ids of trusted documents, and thresholds, are broadcast up to so many bytes, else joined by exchange.
BROADCAST_BYTES = 64 << 20
LEAST_DISCOUNT = 0.05
#: A symbol takes 21 bits, as code points do.  Start of a text, and a word like the one before.
BITS = 21
START, AGAIN = 2, 0x10FFFE
MASK = (1 << BITS) - 1


def symbols(text: str) -> np.ndarray:
    words = text.split()
    if any(map(operator.eq, words, words[1:])):
        text = "".join(chr(AGAIN) if word == before else " " + word for word, before in zip(words, [None, *words]))
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of a text, two start symbols before it, as numbers, and their counts."""
    line = np.concatenate([np.array([START, START], dtype=np.int64), symbols(text)])
    return np.unique(line[:-2] << (2 * BITS) | line[1:-1] << BITS | line[2:], return_counts=True)


def _pack(values: np.ndarray) -> bytes:
    return pack_bytes(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unpack_bytes(data), dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _counted(docs: DataFrame, id_column: str, block_characters: int) -> DataFrame:
    """A stored table of blocks of documents with their trigram counts.

    ``docs`` has the id, _text, _lang and _trusted.  vocabulary lists the block's (lang, gram);
    sizes how many distinct trigrams each document has; places and counts belong to them.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size, id_type = 0, [], 0, None

        def block() -> pa.RecordBatch:
            langs, grams, places = [], [], {}
            for lang in dict.fromkeys(row[1] for row in held):
                known = np.unique(np.concatenate([row[3] for row in held if row[1] == lang]))
                places[lang] = (known, len(grams))
                langs += [lang] * len(known)
                grams += known.tolist()
            at = [np.diff(places[lang][1] + np.searchsorted(places[lang][0], own), prepend=0) for _, lang, _, own, _ in held]
            vocabulary = pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(grams, pa.int64())], ["lang", "gram"])
            return pa.RecordBatch.from_arrays([
                pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()),
                pa.array([[row[0] for row in held]], pa.list_(id_type)),
                pa.array([[row[1] for row in held]], pa.list_(pa.string())),
                pa.array([[row[2] for row in held]], pa.list_(pa.bool_())),
                pa.ListArray.from_arrays(pa.array([0, len(grams)], pa.int32()), vocabulary),
                pa.array([[len(row[3]) for row in held]], pa.list_(pa.int32())),
                pa.array([_pack(np.concatenate(at))], pa.binary()),
                pa.array([_pack(np.concatenate([row[4] for row in held]))], pa.binary()),
            ], ["block", "ids", "langs", "trusted", "vocabulary", "sizes", "places", "counts"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, text, lang, trusted in zip(*(column.to_pylist() for column in batch.columns)):
                if held and size + len(text) > block_characters:
                    yield block()
                    number, held, size = number + 1, [], 0
                held.append((key, lang, trusted, *trigrams(text)))
                size += len(text)
        if held:
            yield block()

    return materialise(docs.select(id_column, "_text", "_lang", "_trusted").mapInArrow(
        count, f"block long, ids array<{kind}>, langs array<string>, trusted array<boolean>,"
               " vocabulary array<struct<lang:string,gram:long>>, sizes array<int>, places binary, counts binary"), "counts")


def _documents(row: dict) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Places in the vocabulary, and counts, of each document of a block."""
    ends = np.cumsum(row["sizes"])[:-1]
    return [np.cumsum(steps) for steps in np.split(_unpack(row["places"]), ends)], np.split(_unpack(row["counts"]), ends)


def _trusted_counts(blocks: DataFrame) -> DataFrame:
    """(lang, gram, n) over the trusted documents."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                total = np.zeros(len(row["vocabulary"]), dtype=np.int64)
                for trusted, places, counts in zip(row["trusted"], *_documents(row)):
                    if trusted:
                        total[places] += counts
                used = np.flatnonzero(total)
                words = [row["vocabulary"][i] for i in used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w["lang"] for w in words], pa.string()), pa.array([w["gram"] for w in words], pa.int64()),
                     pa.array(total[used], pa.int64())], ["lang", "gram", "n"])

    return blocks.mapInArrow(add, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame, order: int) -> DataFrame:
    """Per language d1, d2, d3 of one order from its counts of counts; a half for each step of
    one where too few are known, and never nothing, so that all grams keep some probability."""
    def of(k: int) -> Column:
        return F.count_if(F.col("n") == k).cast("double")

    totals = counts.groupBy("lang").agg(*[of(k).alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def discount(k: int) -> Column:
        own = k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
        usable = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col(f"n{k}") > 0)
        return F.when(usable, F.greatest(F.lit(LEAST_DISCOUNT), F.least(F.lit(float(k)), own))).otherwise(F.lit(0.5 * k)).alias(f"d{k}_{order}")

    return totals.select("lang", *[discount(k) for k in (1, 2, 3)])


def _discount(order: int, n: str) -> Column:
    return F.when(F.col(n) == 1, F.col(f"d1_{order}")).when(F.col(n) == 2, F.col(f"d2_{order}")).otherwise(F.col(f"d3_{order}"))


def _contexts(counts: DataFrame, discounts: DataFrame, order: int, keys: list[str]) -> DataFrame:
    """Per context its total, and the mass that its discounts free for the lower order."""
    return counts.join(discounts, "lang").groupBy(*keys).agg(
        F.sum("n").alias(f"t{order}"), F.sum(F.least(F.col("n").cast("double"), _discount(order, "n"))).alias(f"g{order}"))


def train(counts: DataFrame) -> dict[str, DataFrame]:
    """The stored tables of the model from (lang, gram, n).

    The lower orders count in how many different contexts a gram stands, as Kneser and Ney do.
    """
    three = counts.withColumns({"ab": F.shiftright("gram", BITS), "bc": F.col("gram").bitwiseAND(F.lit((1 << 2 * BITS) - 1))})
    two = three.groupBy("lang", "bc").agg(F.count("*").alias("n")).withColumns(
        {"b": F.shiftright("bc", BITS), "c": F.col("bc").bitwiseAND(F.lit(MASK))})
    one = two.groupBy("lang", "c").agg(F.count("*").alias("n"))
    d3, d2, d1 = _discounts(three, 3), _discounts(two, 2), _discounts(one, 1)
    tables = {
        "three": three.select("lang", "gram", F.col("n").alias("n3")),
        "two": two.select("lang", "bc", F.col("n").alias("n2")),
        "one": one.select("lang", "c", F.col("n").alias("n1")),
        "before3": _contexts(three, d3, 3, ["lang", "ab"]),
        "before2": _contexts(two, d2, 2, ["lang", "b"]),
        "lang": _contexts(one, d1, 1, ["lang"]).join(one.groupBy("lang").agg(F.count("*").alias("symbols")), "lang")
        .join(d3, "lang").join(d2, "lang").join(d1, "lang"),
    }
    return {name: materialise(table, f"model-{name}") for name, table in tables.items()}


def log_probabilities(asked: DataFrame, model: dict[str, DataFrame]) -> DataFrame:
    """(lang, gram, logp) of the asked (lang, gram), in languages that the model knows."""
    parts = asked.withColumns({
        "ab": F.shiftright("gram", BITS), "bc": F.col("gram").bitwiseAND(F.lit((1 << 2 * BITS) - 1)),
        "b": F.shiftright("gram", BITS).bitwiseAND(F.lit(MASK)), "c": F.col("gram").bitwiseAND(F.lit(MASK))})
    joined = (
        parts.join(model["lang"], "lang")
        .join(model["three"], ["lang", "gram"], "left").join(model["before3"], ["lang", "ab"], "left")
        .join(model["two"], ["lang", "bc"], "left").join(model["before2"], ["lang", "b"], "left")
        .join(model["one"], ["lang", "c"], "left")
    )

    def interpolated(order: int, lower: Column) -> Column:
        n = F.coalesce(F.col(f"n{order}"), F.lit(0))
        own = F.greatest(n - _discount(order, f"n{order}"), F.lit(0.0))
        return (F.when(n > 0, own).otherwise(F.lit(0.0)) + F.col(f"g{order}") * lower) / F.col(f"t{order}")

    # One symbol more than known: whatever was never seen.
    p1 = interpolated(1, 1 / (F.col("symbols") + 1))
    p2 = F.when(F.col("t2").isNull(), p1).otherwise(interpolated(2, p1))
    p3 = F.when(F.col("t3").isNull(), p2).otherwise(interpolated(3, p2))
    return joined.select("lang", "gram", F.log(p3).alias("logp"))


def _scores(blocks: DataFrame, answers: DataFrame, id_column: str) -> DataFrame:
    listed = answers.groupBy("block").agg(F.collect_list(F.struct("place", "logp")).alias("answers"))
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers = batch.column("answers")
            for at, row in enumerate(batch.drop_columns(["answers"]).to_pylist()):
                logp = np.full(row["vocabulary"], np.nan)
                if answers[at].is_valid:
                    said = answers[at].values
                    logp[said.field("place").to_numpy()] = said.field("logp").to_numpy()
                n, total, rarest = [], [], []
                for places, counts in zip(*_documents(row)):
                    n.append(int(counts.sum()))
                    own = logp[places]
                    total.append(float((own * counts).sum()) if n[-1] else np.nan)
                    least = np.argpartition(own, RAREST)[:RAREST] if len(own) > RAREST else np.arange(len(own))
                    least = least[np.argsort(own[least], kind="stable")]
                    rarest.append(float(np.repeat(own[least], np.minimum(counts[least], RAREST))[:RAREST].mean()) if n[-1] else np.nan)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], batch.schema.field("ids").type.value_type), pa.array(row["langs"], pa.string()),
                     pa.array(row["trusted"], pa.bool_()), pa.array(n, pa.int64()), pa.array(total, pa.float64(), from_pandas=True),
                     pa.array(rarest, pa.float64(), from_pandas=True)],
                    [id_column, "lang", "trusted", "n_symbols", "logp", "rarest"])

    held = blocks.select("block", "ids", "langs", "trusted", F.size("vocabulary").alias("vocabulary"), "sizes", "places", "counts")
    return held.join(listed, "block", "left").drop("block").mapInArrow(
        score, f"`{id_column}` {kind}, lang string, trusted boolean, n_symbols long, logp double, rarest double")


def classify_quality(docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, id_column: str = "doc_id",
                     text_column: str = "text", lang_column: str = "lang",
                     block_characters: int = BLOCK_CHARACTERS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per row of ``docs``: id, lang, trusted, n_symbols, perplexity, threshold, kept, and in the same way
    rarity, rarity_threshold, clean.  ``kept`` does not depend on ``clean``; ``accepted`` is both.

    ``trusted`` lists ids (in a column named like ``id_column``) of texts to learn from, all of which
    are used; ids that are not in ``docs`` or null have no effect.  A null text is empty; an empty
    text has no perplexity and is kept, there being nothing against it.  A null language is a language
    of its own, the empty one.  Languages without trusted text have no model: their documents have
    neither perplexity nor threshold and are kept.  Repeated rows are counted and judged each for
    itself.  Empty tables give an empty result.  The quantile is an approximate one, by
    rank within a ten-thousandth.
    """
    ids = trusted.select(F.col(f"`{id_column}`").alias("_key")).filter("_key IS NOT NULL").distinct()
    # Ids of any type, by the bytes they are written with.
    held = ids.agg(F.sum(F.octet_length(F.col("_key").cast("string")) + F.lit(32))).first()[0] or 0
    small = held <= broadcast_bytes
    chosen = docs.select(
        F.col(f"`{id_column}`"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("_text"),
        F.coalesce(F.col(f"`{lang_column}`"), F.lit("")).alias("_lang"))
    ids = ids.withColumn("_yes", F.lit(True))
    flagged = chosen.join(F.broadcast(ids) if small else ids, F.col(f"`{id_column}`") == F.col("_key"), "left").withColumn(
        "_trusted", F.coalesce("_yes", F.lit(False)))
    blocks = _counted(flagged, id_column, block_characters)
    model = train(materialise(_trusted_counts(blocks), "trusted"))
    wanted = blocks.select("block", F.posexplode("vocabulary").alias("place", "_word")).select("block", "place", "_word.lang", "_word.gram")
    known = materialise(log_probabilities(wanted.select("lang", "gram").distinct(), model), "logp")
    answers = wanted.join(known, ["lang", "gram"]).select("block", "place", "logp")
    scored = materialise(_scores(blocks, answers, id_column).withColumns(
        {"perplexity": F.exp(-F.col("logp") / F.col("n_symbols")), "rarity": F.exp(-F.col("rarest"))}), "scores")
    thresholds = materialise(scored.filter("trusted AND perplexity IS NOT NULL").groupBy("lang").agg(
        F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"),
        F.percentile_approx("rarity", quantile, 10_000).alias("rarity_threshold")), "thresholds")
    # A language may hold most documents: they stay where they are, unless languages are very many.
    few = thresholds.count() * 64 <= broadcast_bytes
    return scored.join(F.broadcast(thresholds) if few else thresholds, "lang", "left").select(
        id_column, "lang", "trusted", "n_symbols", "perplexity", "threshold",
        F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept"), "rarity", "rarity_threshold",
        F.coalesce(F.col("rarity") <= F.col("rarity_threshold"), F.lit(True)).alias("clean")).withColumn("accepted", F.col("kept") & F.col("clean"))
