"""Text weights as an inverted index, and best-n search that skips what cannot reach the result.

``build`` stores the blocks of texts (``text_blocks``) and, inverted, a row per word and block: the
places of the texts that have the word, how often, and the highest weight. These rows lie in hash ranges of the words, sorted by
word hash and block, so the statistics of a file's row groups tell which words and blocks it
holds. A block is some thousand texts of about the same number of words: short texts have high
weights, so blocks differ in what they can reach. The highest weights are the bounds; they are read
without the texts. Lengths and keys stand with the blocks, so a posting is a place and a count.

``search`` adds up, per block, query weight times bound. The blocks with the highest sums
are scored in full; the n-th best score there is a threshold, and of the other
blocks only those are read whose sum reaches it. Every block that is read is read for
all words of the query, so scores are exact, and a block that is left out cannot hold
a result, ties included.

A request's words go to the driver (they are the request), and so do at most ``CELLS``
ranges of blocks; postings never do.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions.cells import words
from tallyworks.operators import text_blocks
from tallyworks.operators.words import ZERO_WEIGHT, explode_words
from tallyworks.session import discard, free_shuffles

# Texts of a block at most, and postings of a hash range on average.
BLOCK_TEXTS = 2048
RANGE_POSTINGS = 4_000_000
# Postings are dealt out in so many (two to this power) passes at most; a pass's shuffle goes before the next.
PASS_BITS = 2
# Ranges of word hashes, or of blocks, that one scan is asked for.
RANGES = 32
CELLS = 4096
# Scores are compared when rounded; a bound may be this much short of the threshold.
SLACK = 1e-8


def _hash(word: Column) -> Column:
    return F.xxhash64(word)


def _range(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, 64 - bits).cast("int") if bits else F.lit(0)


def build(weights: DataFrame, key: str, idf: DataFrame, path: str) -> None:
    """Store (key, word, weight) rows and the (word, df, idf) vocabulary as an index under ``path``.

    Weights of ``text_weights`` come with their blocks; others are put into blocks first.
    """
    spark, kind = weights.sparkSession, weights.schema[key].dataType.simpleString()
    blocks = getattr(weights, "text_blocks", None)
    own = None if blocks else text_blocks.plain(weights, key, BLOCK_TEXTS)
    blocks = blocks or own
    blocks.write.options(**text_blocks.WIDE).parquet(f"{path}/texts")
    postings = blocks.agg(F.sum("n")).first()[0] or 0
    bits = min(12, max(0, (postings // RANGE_POSTINGS).bit_length()))
    for i in range(1 << min(bits, PASS_BITS)):
        _store_postings(blocks, bits, i, f"{path}/postings")
        free_shuffles(spark)
    _store(idf.select(_hash(F.col("word")).alias("h"), "word", "df", "idf"), ["h"], bits, f"{path}/vocabulary")
    spark.createDataFrame([(bits, key, kind)], "bits int, key string, kind string").coalesce(1).write.parquet(f"{path}/about")
    if own:
        discard(own)


def _store_postings(blocks: DataFrame, bits: int, i: int, path: str) -> None:
    """The ``i``-th part of the hash ranges, sorted by hash and block. Hashes are spread evenly and dealt to two
    tasks a range, so no sample of the rows is needed."""
    first, tasks = min(bits, PASS_BITS), 2 << max(0, bits - PASS_BITS)
    h = _hash(F.col("word"))
    dealt = text_blocks.inverted(blocks, lambda w: _range(_hash(w), first) == i).repartitionById(tasks, F.pmod(_range(h, bits + 1), F.lit(tasks)))
    rows = dealt.select(h.alias("h"), "block", "word", "factor", F.size("slots").cast("long").alias("n"), "top", "slots", "values")
    rows.withColumn("range", _range(F.col("h"), bits)).sortWithinPartitions("range", "h", "block").write.mode("append").partitionBy(
        "range").options(**{"compression": "zstd", "parquet.block.size": 1 << 20}).parquet(path)


def _schemas(key: str, kind: str) -> dict[str, str]:
    """Schemas of the parts; an empty part has no file to tell one."""
    return {"texts": text_blocks.schema(f"array<{kind}>"),
            "postings": "h long, block long, word string, factor double, n long, top double, slots array<int>, "
                        "values array<double>, range int",
            "vocabulary": "h long, word string, df long, idf double, range int"}


def _store(rows: DataFrame, order: Sequence[str], bits: int, path: str) -> None:
    """Rows range-sorted by hash, in a folder per hash range, with small row groups."""
    placed = rows.withColumn("range", _range(F.col("h"), bits))
    placed.repartitionByRange(*order).sortWithinPartitions("range", *order).write.partitionBy("range").option(
        "parquet.block.size", 1 << 20).parquet(path)


def intervals(numbers: Sequence[int], most: int = RANGES) -> list[tuple[int, int]]:
    """At most ``most`` closed ranges that cover the numbers, parted at the widest gaps."""
    given = sorted(set(numbers))
    gaps = sorted(range(1, len(given)), key=lambda i: given[i - 1] - given[i])[:most - 1]
    cuts = [0, *sorted(gaps), len(given)]
    return [(given[a], given[b - 1]) for a, b in zip(cuts[:-1], cuts[1:]) if a < b]


def _within(column: str, ranges: list[tuple[int, int]]) -> Column:
    out = F.lit(False)
    for low, high in ranges:
        out = out | ((F.col(column) >= low) & (F.col(column) <= high))
    return out


class Index:
    """A stored index."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        about = spark.read.parquet(f"{path}/about").first()
        self.bits, self.key = about["bits"], about["key"]
        self.schemas = _schemas(self.key, about["kind"])

    def _part(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{name}")

    def _read(self, part: str, hashes: Sequence[int]) -> DataFrame:
        """Rows of the words with these hashes: folders, row groups and rows of other words are left out."""
        ranges = sorted({(h & (1 << 64) - 1) >> (64 - self.bits) if self.bits else 0 for h in hashes})
        return self._part(part).where(
            F.col("range").isin(ranges) & _within("h", intervals(hashes)) & F.col("h").isin(list(hashes)))

    def weights(self) -> DataFrame:
        """(key, word, weight) as given."""
        return text_blocks.expanded(self._part("texts"), self.key)

    def vocabulary(self) -> DataFrame:
        return self._part("vocabulary").select("word", "df", "idf")

    def word_bounds(self) -> DataFrame:
        """(word, texts, top): texts that hold a word, and its highest weight."""
        return self._part("postings").groupBy("word").agg(
            F.sum("n").alias("texts"), F.max("top").alias("top"))

    def query(self, texts: DataFrame, text: str, cut: Callable[[Column], Column] = words) -> list[tuple[str, int, float]]:
        """(word, hash, weight) of all given texts as one query of length 1; unknown words drop out."""
        asked = explode_words(texts.select(text), text, cut).groupBy("word").agg(F.count(F.lit(1)).alias("tf")).withColumn(
            "h", _hash(F.col("word"))).collect()
        if not asked:
            return []
        known = {r["word"]: r["idf"] for r in self._read("vocabulary", [r["h"] for r in asked]).join(
            self.spark.createDataFrame([(r["word"],) for r in asked], "word string"), "word").select("word", "idf").collect()}
        weighted = [(r["word"], r["h"], r["tf"] * known[r["word"]]) for r in asked if r["word"] in known]
        weighted = [w for w in weighted if abs(w[2]) > ZERO_WEIGHT]
        length = sum(w[2] * w[2] for w in weighted) ** 0.5
        return [(word, h, x / length) for word, h, x in weighted]

    def _scores(self, query: DataFrame, hashes: list[int], blocks: Column) -> DataFrame:
        met = self._read("postings", hashes).where(blocks).join(query, ["h", "word"])
        products = met.select("block", (F.col("factor") * F.col("query_weight")).alias("x"),
                              F.explode(F.arrays_zip("slots", "values")).alias("p"))
        sums = products.groupBy("block", F.col("p.slots").alias("slot")).agg(F.sum(F.col("p.values") * F.col("x")).alias("x"))
        texts = self._part("texts").where(blocks).select(
            "block", F.posexplode(F.arrays_zip("keys", "lengths")).alias("slot", "t"))
        return sums.join(texts, ["block", "slot"]).select(
            F.col("t.keys").alias(self.key), (F.col("x") / F.col("t.lengths")).alias("similarity"))

    def block_limits(self, query: DataFrame, hashes: list[int]) -> DataFrame:
        """(block, most): no text of the block has a higher score."""
        return self._read("postings", hashes).join(query, ["h", "word"]).groupBy("block").agg(
            F.sum(F.col("top") * F.col("query_weight")).alias("most"))

    def search(self, query: list[tuple[str, int, float]], n: int = 20, first: int = 8) -> DataFrame:
        """The ``n`` texts with the highest cosine; ties go to the smaller key."""
        rows = self.spark.createDataFrame(query, "word string, h long, query_weight double")
        hashes = [h for _, h, _ in query]
        order = [F.desc(F.round("similarity", 9)), F.col(self.key)]
        if not query:
            return self._scores(rows, [0], F.lit(False)).orderBy(*order).limit(n)
        limits = self.block_limits(rows, hashes)
        lead = limits.orderBy(F.desc("most"), "block").limit(first).collect()
        if not lead:
            return self._scores(rows, hashes, F.lit(False)).orderBy(*order).limit(n)
        best = self._scores(rows, hashes, F.col("block").isin([r["block"] for r in lead])).orderBy(*order).limit(n).collect()
        least = best[-1]["similarity"] - SLACK if len(best) == n else float("-inf")
        return self._scores(rows, hashes, self.reachable(limits, least)).orderBy(*order).limit(n)

    def reachable(self, limits: DataFrame, least: float) -> Column:
        """Condition on ``block``: ranges that cover every block whose limit is ``least`` or more."""
        met = limits.where(F.col("most") >= F.lit(least))
        # neighbouring blocks share a cell, so the driver gets a bounded number of them
        low, high = met.agg(F.min("block"), F.max("block")).first()
        width = max(1, -(-(high - low + 1) // CELLS))
        cells = met.groupBy(F.floor((F.col("block") - F.lit(low)) / F.lit(width)).alias("c")).agg(
            F.min("block").alias("low"), F.max("block").alias("high")).collect()
        spans = sorted((r["low"], r["high"]) for r in cells)
        gaps = sorted(range(1, len(spans)), key=lambda i: spans[i - 1][1] - spans[i][0])[:RANGES - 1]
        cuts = [0, *sorted(gaps), len(spans)]
        return _within("block", [(spans[a][0], spans[b - 1][1]) for a, b in zip(cuts[:-1], cuts[1:]) if a < b])
