"""Word cut by a dictionary: the most likely path through a text's word graph.

A dictionary is a table of words with weights. Within a run of text every word that stands
in the dictionary is an edge from its first character to behind its last one; single
characters are edges too. The path with the highest product of shares is the cut, found
from the end of the run backwards; of equal paths the one with the longer first word counts.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Runs that are cut if nothing else is said: Chinese characters.
RUNS = r"\p{Han}+"


class Cutter:
    """Cuts runs with a dictionary; each distinct run is cut once, the last ``held`` of them are kept."""

    def __init__(self, weights: dict[str, float], held: int = 100_000):
        total = math.log(max(sum(weights.values()), 1.0))
        self.log = {w: math.log(n) - total for w, n in weights.items()}
        self.unknown = -total
        self.prefixes = {w[:k] for w in weights for k in range(1, len(w) + 1)}
        self.known: dict[str, list[str]] = {}
        self.held = held

    def cut(self, run: str) -> list[str]:
        if run not in self.known:
            if len(self.known) >= self.held:
                self.known.clear()
            self.known[run] = self._cut(run)
        return self.known[run]

    def _cut(self, run: str) -> list[str]:
        best, step = [0.0] * (len(run) + 1), [0] * len(run)
        for i in range(len(run) - 1, -1, -1):
            best[i], step[i] = self.log.get(run[i], self.unknown) + best[i + 1], i + 1
            for j in range(i + 2, len(run) + 1):
                word = run[i:j]
                if word not in self.prefixes:
                    break
                if word in self.log and self.log[word] + best[j] >= best[i]:
                    best[i], step[i] = self.log[word] + best[j], j
        out, i = [], 0
        while i < len(run):
            out.append(run[i:step[i]])
            i = step[i]
        return out


def read_dictionary(words: DataFrame, word: str = "word", weight: str = "n", most: int = 1_000_000) -> dict[str, float]:
    """Words and weights on the driver, checked in size before; words with the same text add up."""
    rows = words.where(F.col(word).isNotNull() & (F.col(word) != "") & (F.col(weight) > 0)).groupBy(word).agg(
        F.sum(weight).cast("double").alias("w"))
    n = rows.count()
    if n > most:
        raise ValueError(f"a dictionary of {n} words is more than tasks are to hold ({most})")
    return {r[word]: r["w"] for r in rows.collect()}


def cut_texts(df: DataFrame, text: str, dictionary: dict[str, float], runs: str = RUNS) -> DataFrame:
    """``df`` with spaces put between the words of every run; what is no run stays, as do the other columns.

    Word counts and weights then take the result with a cut at spaces (``split_words``).
    """
    sent = df.sparkSession.sparkContext.broadcast(dictionary)
    at = df.columns.index(text)

    def cut(batches):
        import regex

        cutter, find = Cutter(sent.value), regex.compile(runs)
        for batch in batches:
            texts = [None if t is None else find.sub(lambda m: f" {' '.join(cutter.cut(m[0]))} ", t)
                     for t in batch.column(at).to_pylist()]
            columns = [pa.array(texts, batch.schema.field(at).type) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)
    return df.mapInArrow(cut, df.schema)


def split_words(c):
    """Words between spaces, empty ones left out."""
    return F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != "")
