"""The source audit against dense counting with Python's whole numbers."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import divergence
from tests.llm import brute
from tests.llm.test_texts import ODD, SCHEMA


def by_hand(rows, least, most):
    texts = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(brute.LOWER))) for _, t, lang, source in rows]
    out = set()
    for lang in {r[0] for r in texts}:
        seen = Counter(w for lg, _, words in texts if lg == lang for w in set(words))
        kept = [w for w, n in seen.items() if n >= least]
        counts = defaultdict(Counter)
        for lg, source, words in texts:
            if lg == lang:
                counts[source].update(w for w in words if w in set(kept))
        everyone = sum(counts.values(), Counter())
        shares = lambda c: {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept)) for w in kept}
        of_lang, of = shares(everyone), {s: shares(c) for s, c in counts.items()}
        for source, p in of.items():
            pairs = [(-sum(abs(p[w] - q[w]) for w in kept), other) for other, q in of.items() if other != source]
            terms = [(of_lang[w] - p[w], w) for w in kept if counts[source][w] and p[w] > of_lang[w]]
            for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:most])):
                ordered = sorted(found, key=lambda x: (x[0], x[1].encode()))
                out |= {(lang, source, part, item, -v, i) for i, (v, item) in enumerate(ordered, 1)}
    return out


def texts(n=400):
    rng = random.Random(3)
    names = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["Éa", "éa", "你好", "B-c"]
    rows = []
    for i in range(n):
        source = f"s{rng.randrange(9)}"
        words = rng.choices(names, weights=[1 / (1 + j % (3 + int(source[1]))) for j in range(len(names))], k=rng.randrange(40))
        rows.append((i, " ".join(w.upper() if rng.random() < 0.2 else w for w in words), rng.choice(["en", "de", None]), source))
    return rows


@pytest.mark.parametrize("options", [{}, {"block_entries": 60, "tile": 2}, {"most_terms": 3}])
def test_audit_against_dense_counts(spark, options):
    rows = [*texts(), *ODD, (900, "lonely words", "xx", "only"), (901, None, "yy", "p"), (902, "", "yy", "q"), (903, "1 2 3", "yy", None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"term": F.lit("mine"), "n": F.lit(3), "part": F.lit("x"), "counts": F.lit(1)})
    found = divergence.audit(docs.repartition(4), min_documents=7, **options).collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == by_hand(rows, 7, options.get("most_terms", divergence.MOST_TERMS))


def test_no_rows(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []
    none_kept = divergence.audit(spark.createDataFrame(texts(20), SCHEMA)).collect()
    assert none_kept and {(r.part, r.value) for r in none_kept} == {("pair", 0)}


def test_shares_of_huge_counts(spark):
    import numpy as np

    counts = [0, 1, 10**9, 7 * 10**14, 9 * 10**14]
    total, terms = 10**15, 3_000_000
    want = [1 + 10**9 * (c + 5) // (total + 5 * terms) for c in counts]
    assert divergence._shares(np.array(counts), total, terms).tolist() == want
    rows = spark.createDataFrame([(c,) for c in counts], "c bigint").select(
        divergence.share(F.col("c"), F.lit(total).cast("bigint"), F.lit(terms).cast("bigint")).alias("p")
    )
    assert [r.p for r in rows.collect()] == want
