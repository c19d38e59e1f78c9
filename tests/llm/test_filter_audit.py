"""The filter audit against counting by hand, on odd rows."""

import re
from collections import Counter, defaultdict
from itertools import permutations

from pyspark.sql import functions as F

from millrace.llm import filter_audit
from tests.llm import brute
from tests.llm.test_texts import ODD, SCHEMA

PROSE = " ".join(f"word{i}" for i in range(60))
LOUD = " ".join(f"WORD{i}" for i in range(60))
DULL = "a b c " * 30
ROWS = [
    *ODD,
    (20, PROSE, "en", "a"), (21, PROSE, "en", "b"), (22, PROSE, "de", None), (22, PROSE, "de", None), (None, PROSE, "de", ""),
    (20, PROSE, "en", "b"), (23, LOUD, "en", "a"), (24, DULL, "en", "a"), (25, DULL + "#", "en", "b"), (26, LOUD + " & |", "en", "b"),
    (27, "", "en", "a"), (28, "É" * 20 + "A", "en", "zz"), (29, "x" * 18 + "AB", "en", "zz"), (30, "x" * 19 + "A", "en", "zz"),
]
LABELS = [(20, 1, 0), (20, 0, 1), (21, 1, 0), (23, 0, 1), (24, 1, 1), (25, None, 1), (None, 1, 1), (27, 1, None), (99, 1, 1)]


def failed(doc_id, text, smallest):
    text = text or ""
    words = brute.words(text)
    return (
        len(words) < 50,
        100 * len(set(words)) < 65 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
        doc_id is not None and smallest[text] < doc_id,
    )


def by_hand(rows, labels):
    smallest = {}
    for doc_id, text, _, _ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    judged = [(source or "", failed(d, t, smallest), d in good, d in toxic) for d, t, _, source in rows]
    parts = {p for p, *_ in judged}
    out, shapley = {}, Counter()
    for order in permutations(range(5)):
        name = "".join("ABCDE"[f] for f in order)
        left = judged
        for step, f in enumerate(order, 1):
            gone = [r for r in left if r[1][f]]
            left = [r for r in left if not r[1][f]]
            for p in parts:
                here = [r for r in gone if r[0] == p]
                out[p, name, step] = [
                    sum(r[0] == p for r in left),
                    len(here),
                    sum(r[0] == p and r[1][f] for r in judged) - len(here),
                    sum(r[0] == p and r[1][f] and sum(r[1]) == 1 for r in judged),
                    sum(r[2] for r in here),
                    sum(r[3] for r in here),
                ]
                shapley[p, f] += len(here)
    for (p, name, step), cells in out.items():
        cells.append(shapley[p, "ABCDE".index(name[step - 1])])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_against_counting(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({"part": F.lit("mine"), "mask": F.lit(31), "same": F.lit(1), "n": F.lit("x")})
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    found = filter_audit.audit(docs.repartition(3), labels).collect()
    want = by_hand(ROWS, LABELS)
    assert len(found) == len(want)
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found} == want
    assert sum(sum(v[:2]) for v in want.values())  # not empty by accident


def test_no_rows_and_no_labels(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(docs.limit(0), labels).collect() == []
    assert {(r.good_lost, r.toxic_lost) for r in filter_audit.audit(docs, labels).collect()} == {(0, 0)}


def test_intervals_cover_each_order_once():
    orders = list(permutations(range(5)))
    covered = defaultdict(Counter)
    for mask, step, first, end in filter_audit.removal_intervals().tolist():
        for rank in range(first, end):
            covered[mask][rank] += 1
            order = orders[rank]
            assert mask >> order[step] & 1 and not any(mask >> f & 1 for f in order[:step])
    assert all(covered[m] == Counter(range(120)) for m in range(1, 32))
    assert [filter_audit.lehmer_rank(o) for o in orders] == list(range(120))
