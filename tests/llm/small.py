"""A small table with the cases every operator must handle."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, key string, `order` int, label int"
_SYLLABLES = "an er in on ti es en at re th ou lé ña ße".split()


def word(rng: random.Random) -> str:
    return "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4)))


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(word(rng) for _ in range(n))


def texts(seed: int = 1) -> list[str | None]:
    """Empty, short, long, copied, nearly copied and repetitive texts."""
    rng = random.Random(seed)
    base, passage = sentence(rng, 150), sentence(rng, 70)
    words = base.split()
    out: list[str | None] = [None, "", " \t\n", "Eins", "eins", "a b c d", "A b  c d", base, base, base.upper(),
                             " ".join(["to"] * 60), "\n".join(["the same line here"] * 9)]
    for at in (5, 60, 120):
        out.append(" ".join(words[:at] + ["changed"] + words[at + 1:]))
    out.append(" ".join(words[:75] + sentence(rng, 75).split()))
    for _ in range(6):
        out.append(f"{sentence(rng, rng.randint(5, 60))}\n{passage} {sentence(rng, rng.randint(0, 40))}")
    out.append(sentence(rng, 3000) + " " + passage)
    out.append("ab" * 300 + " mid " + "ab" * 300)
    out += [sentence(rng, rng.randint(1, 300)) + " ### $$$ | <b>　x\x85" for _ in range(8)]
    return out


def rows(seed: int = 1) -> list[tuple]:
    """Distinct doc_ids in no order; extra columns whose names the operators use themselves."""
    given = texts(seed)
    ids = list(range(3, 3 + 7 * len(given), 7))
    random.Random(seed).shuffle(ids)
    return [(i, t, ("en", "de", None)[k % 3], "src0" if k % 3 else None, None if t is None else len(t), "k", k, k % 2)
            for k, (i, t) in enumerate(zip(ids, given))]


def documents(spark, given=None, parts: int = 3):
    return spark.createDataFrame(rows() if given is None else given, DOCUMENTS).repartition(parts)


def odd_documents(spark):
    """The same with rows without doc_id and repeated rows."""
    given = rows()
    return documents(spark, given + given[:9] + [(None, t, "en", "x", 1, None, None, None) for t in texts()[:9]])


def by_id(df) -> dict:
    return {r["doc_id"]: r for r in df.collect()}
