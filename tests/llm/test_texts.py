"""Operators over texts against brute force, on the small tables and on odd rows."""

import hashlib
import json
import random
import struct
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, chosen_path, licenses, outliers, queries, substrings, token_files, toxicity
from millrace.sources.scratch import scratch_path
from tests.llm import brute

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
PASSAGE = " ".join(f"pass{i}" for i in range(40))
ODD = [
    (1, "", "en", "a"),
    (2, None, None, None),
    (3, LONG, "en", "a"),
    (4, PASSAGE, "en", "a"),
    (5, f"other start {PASSAGE} and another end", "en", None),
    (5, f"other start {PASSAGE} and another end", "en", None),
    (None, PASSAGE, "de", "b"),
    (None, None, "de", "b"),
    (6, LONG + " end", None, "b"),
    (7, "one two", "en", "a"),
    (8, "ONE\ttwo", "en", "a"),
    (9, " \n\t ", "en", "a"),
    (10, "\n".join(["same line of five words"] * 6), "en", "a"),
    (11, "a b a b a b a b a b a b a b", "en", "a"),
    (12, "Grüße ÉÉ K x\x1fy 你好 " * 7, "fr", "c"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    # Columns named like those that operators add or use inside.
    return (
        spark.createDataFrame(ODD, SCHEMA)
        .withColumns({"n_words": F.lit("mine"), "score": F.lit(7), "chunk": F.lit(1), "id": F.lit("x"), "ids": F.lit(2)})
        .repartition(3)
        .cache()
    )


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def check_removals(df, **options):
    rows = pairs(df)
    want = sorted(
        (str(d), len(w), sum(m), " ".join(x for x, gone in zip(w, m) if not gone)) for (d, _), (w, m) in zip(rows, brute.removals(rows))
    )
    found = substrings.remove_repeats(df, **options).select(
        "doc_id", "n_words", "n_removed", F.coalesce("left_text", queries.plain_words()).alias("kept"), "spans"
    )
    found = found.collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in found) == want
    for r in found:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))  # maximal: no two touch


def test_repeated_passages(documents, odd):
    check_removals(documents, chunk_bytes=50_000, bucket_windows=5_000)
    check_removals(odd)
    check_removals(odd, chunk_bytes=1, bucket_windows=1_000)


def test_passage_in_very_many_documents(spark):
    rng = random.Random(1)
    rows = [(i, " ".join([*rng.choices("abcdefgh", k=5), PASSAGE])) for i in range(400)]
    check_removals(spark.createDataFrame(rows, "doc_id bigint, text string"), chunk_bytes=2_000, bucket_windows=100)


def check_components(df, shingle, percent, **options):
    rows = pairs(df)
    want = sorted((str(d), n, str(c)) for (d, _), (n, c) in zip(rows, brute.components(rows, shingle, percent)))
    found = chosen_path.near_duplicates(df, shingle=shingle, percent=percent, **options).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == want
    assert all(r.kept == (r.doc_id == r.component_id or r.doc_id is None) for r in found)


def test_near_copies(documents, odd):
    check_components(documents, 3, 85)
    check_components(documents, 5, 80)
    check_components(odd, 3, 85)


def test_large_group_of_near_copies_and_a_chain(spark):
    """Copies with one word changed, and texts that only touch their neighbours."""
    rng = random.Random(2)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        own = list(base)
        own[rng.randrange(120)] = f"new{i}"
        rows.append((i, " ".join(own)))
    chain = [f"c{i}" for i in range(400)]
    rows += [(1000 + i, " ".join(chain[4 * i : 4 * i + 100])) for i in range(60)]
    rows += [(2000 + i, " ".join(rng.choices(base, k=60))) for i in range(40)]
    check_components(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 80)
    check_components(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 80, leaf=4, deepest=5)


def test_keep_first_keeps_columns(odd):
    kept = chosen_path.keep_first(odd)
    assert kept.columns == odd.columns
    rows = pairs(odd)
    want = [d for (d, _), (_, c) in zip(rows, brute.components(rows, 5, 80)) if d is None or c == d]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, want))


def test_recall_of_trees():
    """A pair at the threshold meets in some node with near certainty."""
    import numpy as np

    rng = np.random.default_rng(3)
    met = 0
    for _ in range(400):
        a = rng.integers(0, 2**32, chosen_path.COORDINATES, dtype=np.uint32)
        b = np.where(rng.random(chosen_path.COORDINATES) < 0.85, a, rng.integers(0, 2**32, chosen_path.COORDINATES, dtype=np.uint32))
        both = np.stack([a, b])
        rows = np.tile([0, 1], chosen_path.TREES)
        paths = np.repeat(rng.integers(0, 2**63, chosen_path.TREES).astype(np.uint64), 2)
        for _ in range(chosen_path.START):
            rows, paths = chosen_path._children(rows, paths, both, 0.85)
        met += bool(set(paths[rows == 0]) & set(paths[rows == 1]))
    assert met >= 399


SPECIAL = [
    "a<|endoftext|>b É İ ΑΣ Σ\x1cx y",
    "x" * 3000,
    "don't I'LL 'S'S é 12345 ½ ٣ K ﬁ 你好 🎉🎉",
    "<|ENDOFTEXT|> <|startoftext|>Hi",
    "ab\x85cd\xa0ef",
    "́ ́a \x00\x01",
    "",
    None,
]


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_ids_and_decoded_texts_equal_the_library(spark, documents, odd):
    tokenizer, path = library(), queries.tokenizer_path()
    special = spark.createDataFrame([(100 + i, t, "en", "s") for i, t in enumerate(SPECIAL)], SCHEMA)
    for df in (documents.select("doc_id", "text", "lang", "source").unionByName(special), odd):
        rows = bpe.decode(bpe.encode(df, path), path)
        for r in rows.collect():
            ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
            assert list(struct.unpack(f"<{len(r.ids) // 4}I", r.ids)) == ids
            assert r.decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_every_code_point_equals_the_library():
    tokenizer, encode = library(), bpe.merge_encoder(queries.tokenizer_path())
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"{chr(c)}x{chr(c).lower()}1" for c in points[at : at + 5000]) for at in range(0, len(points), 5000)]
    for row, end, ids, offsets in encode(pa.array(texts)):
        for i in range(row, end):
            want = tokenizer.encode(texts[i], add_special_tokens=False).ids
            assert ids[offsets[i - row] : offsets[i - row + 1]].tolist() == want


def test_odd_units_equal_the_library():
    """Letters, digits, marks, apostrophes and others in any order."""
    tokenizer, encode = library(), bpe.merge_encoder(queries.tokenizer_path())
    rng = random.Random(12)
    parts = ["a", "Ab", "s", "t", "ll", "'", "'s", "''", "9", "-", ",.", "=", "\u0338", "\u0301", "é", "É", "½", "ß", " ", "\xa0", "你", "\x1c", "<|"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(4000)]
    for row, end, ids, offsets in encode(pa.array(texts)):
        for i in range(row, end):
            want = tokenizer.encode(texts[i], add_special_tokens=False).ids
            assert ids[offsets[i - row] : offsets[i - row + 1]].tolist() == want, texts[i]


def test_scan_and_heap_merge_alike():
    merges = bpe.Merges(bpe.read_file(queries.tokenizer_path())["model"])
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdetionrsé", k=rng.randrange(1, 60))).encode() for _ in range(300)]
    for word, ids in zip(words, merges._scan(words)):
        parts = [merges.inner[b] for b in word[:-1]] + [merges.last[word[-1]]]
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == merges._heap(parts)


def test_token_files(spark, documents, odd):
    tokenizer = library()
    for df in (documents, odd):
        folder = scratch_path(spark, "ids")
        token_files.write_token_files(df, folder, queries.tokenizer_path())
        rows = token_files.read_token_files(spark, folder)
        read = sorted(rows.collect(), key=lambda r: r.start)
        known = [r.doc_id for r in read if r.doc_id is not None]
        assert known == sorted(known)
        texts = {}
        for d, t in pairs(df):
            texts.setdefault(d, []).append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])
        place = 0
        for r in read:
            assert r.start == place and r.n_tokens == len(r.ids) and list(r.ids) in texts[r.doc_id]
            place += r.n_tokens
        sums = {(r.start, r.ids_crc32) for r in token_files.id_checksums(rows).collect()}
        assert sums == {(r.start, zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))) for r in read}
    plan = rows.where("doc_id = 5")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,5)" in plan or "EqualTo(doc_id,5)" in plan


def test_base_rules(documents, odd):
    for df in (documents, odd):
        found = outliers.base_rules(df).collect()
        for r in found:
            want = brute.repeats(r.text)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
    judged = outliers.judge(odd).collect()
    assert len(judged) == len(ODD) and all(r.kept is not None and not (r.kept and r.base_failed) for r in judged)


def concentration(points, least, support=outliers.SUPPORT, steps=outliers.STEPS):
    """Centre and covariance by the same steps in numpy."""
    import numpy as np

    centre = np.median(points, axis=0)
    spread = np.maximum(1.4826 * np.median(np.abs(points - centre), axis=0), least)
    cov = np.diag(spread**2)
    for _ in range(steps):
        off = points - centre
        d = np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off)
        bins = np.floor(np.log2(1 + d) * 16).astype(int)
        edge = np.sort(bins)[int(np.ceil(support * len(bins))) - 1]
        near = points[bins <= edge]
        centre = near.mean(axis=0)
        cov = outliers.CONSISTENCY * np.cov(near.T, bias=True) + np.diag(np.array(least) ** 2)
    return centre, cov


def test_outliers_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    mixing = rng.normal(size=(4, 4))
    points = np.rint(rng.normal(size=(400, 4)) @ mixing * 400 + 1000)
    points[:30] += 20_000
    rows = [("g", *map(int, p)) for p in points]
    stats = spark.createDataFrame(rows, "grp string, x0 bigint, x1 bigint, x2 bigint, x3 bigint").repartition(5)
    fit = outliers.estimates(stats).first()
    centre, cov = concentration(points, outliers.LEAST_SPREAD)
    assert [fit[f"c{i}"] for i in range(4)] == pytest.approx(list(centre))
    factor = np.array([[fit[f"l{i}{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
    assert (factor @ factor.T) == pytest.approx(cov)
    scored = stats.alias("s").crossJoin(outliers.estimates(stats).alias("m")).select("s.x0", outliers._distance().alias("d")).collect()
    assert sorted(r.d > outliers.CUTOFF for r in scored).count(True) == 30


def test_license_scan(spark, odd):
    texts = [
        "CC by cc BY. cc-by! All rights\nreserved",
        "Licensed under the Apache License, Version 2.0.",
        "under version 2.0 of License, Apache licensed",
        "the license\nreleased under MIT",
        "Released under the mit license; all rights reserved",
        "",
    ]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert [(r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows] == [
        (4, 0, 6, "cc-by,reserved"), (0, None, None, ""), (0, None, None, ""), (0, None, None, ""), (1, 5, 5, "reserved"), (0, None, None, ""),
    ]
    assert [r.labels for r in rows] == ["cc-by,reserved", "apache", "apache", "mit", "mit,reserved", ""]
    assert [r.score for r in rows[:3]] == [1.0, 1.0, pytest.approx(7 / 8)] and rows[5].score == 0
    found = licenses.scan(odd).collect()
    assert len(found) == len(ODD) and {r.labels for r in found} == {""}
    assert licenses.scan(odd, phrases={}, templates={}).count() == len(ODD)


def test_toxicity(spark, documents, odd, sf_dir):
    rng = random.Random(6)
    labels, rows = [], []
    for i in range(300):
        bad = i % 4 == 0
        text = rng.choices(["apple", "river", "stone", "cloud", "green"], k=30)
        if bad:
            text[rng.randrange(30)] = rng.choice(["vileness", "viler", "vilest"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    docs, marks = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = toxicity.learn_and_score(docs, marks).collect()
    truth = dict(labels)
    assert all(r.predicted == truth[r.doc_id] for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    # Held-out labels are never read.
    turned = marks.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {(r.doc_id, r.score) for r in toxicity.learn_and_score(docs, turned).collect()} == {(r.doc_id, r.score) for r in found}
    model = toxicity.fit(docs, marks)
    scored = toxicity.score(odd, model).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    for none in (marks.limit(0), marks.where("toxic = 0")):
        assert {0 < r.score < 0.6 for r in toxicity.score(odd, toxicity.fit(docs, none)).collect()} == {True}


def test_long_text_scores_as_its_pieces():
    text = "abc def " * 300_000
    pairs_ = toxicity.present([text])
    counts = dict(zip(pairs_[1].tolist(), pairs_[2].tolist()))
    short = toxicity.present(["abc def abc def "])
    assert set(counts) == set(short[1].tolist())
    assert sum(counts.values()) == sum(len(text) - n + 1 for n in toxicity.ORDERS)


@pytest.mark.parametrize("name", ["remove", "near", "encode", "files", "judge", "scan"])
def test_empty_table(spark, name):
    empty = spark.createDataFrame([], SCHEMA)
    path = queries.tokenizer_path()
    folder = scratch_path(spark, "none")
    run = {
        "remove": lambda: substrings.remove_repeats(empty),
        "near": lambda: chosen_path.near_duplicates(empty),
        "encode": lambda: bpe.decode(bpe.encode(empty, path), path),
        "files": lambda: token_files.write_token_files(empty, folder, path) or token_files.read_token_files(spark, folder),
        "judge": lambda: outliers.judge(empty),
        "scan": lambda: licenses.scan(empty),
    }[name]
    assert run().collect() == []


def test_digests(spark, sf_dir):
    rows = queries.op2_bpe_round_trip(spark, sf_dir).orderBy("doc_id").limit(5).collect()
    tokenizer = library()
    texts = dict(pairs(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert json.dumps([r.doc_id for r in rows])


def test_words_are_remembered_up_to_a_given_size():
    asked = []

    def of(many):
        asked.extend(many)
        return [b"" if w == "empty" else w.encode() for w in many]

    words = [f"w{i}" for i in range(1000)] + ["empty"]
    large, small = bpe.Remembered(of, 1 << 22), bpe.Remembered(of, 1 << 12)
    assert large(words) == [w.encode() for w in words[:-1]] + [b""]
    asked.clear()
    large(words)
    assert not asked  # no ids are an answer too
    small(words)
    small(["x" * bpe.LONGEST_REMEMBERED])
    asked.clear()
    assert small(["w0", "w0"]) == [b"w0", b"w0"] and not asked  # of the old generation
    for i in range(30):
        small([f"{i}" * 20])
    small(["w1"])
    assert "w1" in asked


def test_token_files_remember_more_words_than_the_round_trip():
    path = queries.tokenizer_path()
    encoder, plain = token_files.library_encoder(path), bpe.merge_encoder(path)
    assert encoder.units.most_bytes > plain.units.most_bytes
    texts = pa.array(["a bc", None, "déf <s> g h's 12"] * 3)
    for run_bytes in (4, 1 << 22):
        small = bpe.Encoder(bpe.special_tokens(bpe.read_file(path)), encoder.units, run_bytes)
        found, want = ([i for _, _, ids, _ in e(texts) for i in ids.tolist()] for e in (small, plain))
        assert found == want and len(found) > 9


def test_only_rows_with_a_near_partner_get_their_sets():
    rows = [  # pair, left, right, id, component, n, sketch
        (1, False, False, 10, 10, 100, 0), (1, False, False, 11, 11, 99, 3), (1, False, False, 12, 12, 50, 0),
        (1, False, False, 13, 13, 100, -1), (2, True, False, 10, 10, 100, 0), (2, True, False, 11, 11, 100, 0),
        (2, False, True, 14, 14, 100, 1), (3, True, False, 10, 10, 100, 0), (3, False, True, 15, 10, 100, 0),
    ]
    names = ["pair", "left", "right", "id", "component", "n", "sketch"]
    table = pa.table({name: list(column) for name, column in zip(names, zip(*rows))})
    kept = chosen_path._with_partner(85, 18)(table).to_pylist()
    assert [(r["pair"], r["id"], r["least"]) for r in kept] == [(1, 10, 10), (1, 11, 10), (2, 10, 10), (2, 11, 10), (2, 14, 10)]


def test_runs_of_the_pipeline_stay_small():
    for module in (chosen_path, substrings, bpe):
        assert module._RUN_BYTES <= 1 << 20


def test_hubs_are_found_without_joining_rows_by_document(spark):
    rows = spark.createDataFrame(
        [(1, 10, 9, 0, 10, 3), (1, 11, 9, 0, 11, 3), (1, 12, 9, 0, 12, 3), (2, 11, 9, 0, 11, 2), (2, 13, 9, 0, 13, 2)],
        "node bigint, id bigint, n bigint, sketch bigint, component bigint, size bigint",
    )
    found = chosen_path._Join(rows, 3, 85).with_hub(rows)
    assert sorted((r.a, r.b, r.score) for r in found.collect()) == [(11, 10, 5), (11, 12, 5), (11, 13, 5)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1  # rows with their node's hub


def test_documents_of_large_nodes_branch_once(spark):
    """Below large nodes: what nodes hold, level by level; the first small ones are taken."""
    import numpy as np

    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**32, chosen_path.COORDINATES, dtype=np.uint32)
    minwise = np.where(rng.random((40, chosen_path.COORDINATES)) < 0.6, base, rng.integers(0, 2**32, (40, chosen_path.COORDINATES), dtype=np.uint32))
    tokens = spark.createDataFrame([(i, 9, 0, bytearray(m.tobytes())) for i, m in enumerate(minwise)], "id bigint, n bigint, sketch bigint, minwise binary")
    nodes = (1, 2, 3)
    large = spark.createDataFrame([(k, i, 9, 0, i, 40) for k in nodes for i in range(40)], "node bigint, id bigint, n bigint, sketch bigint, component bigint, size bigint")
    leaf, want = 8, set()
    todo = [(np.arange(40), np.full(40, k, dtype=np.uint64)) for k in nodes]
    for level in (1, 2, 3):
        deeper = [chosen_path._children(rows, paths, minwise, 0.85) for rows, paths in todo]
        todo = []
        for rows, paths in deeper:
            for p in np.unique(paths):
                members = rows[paths == p]
                if len(members) > 1 and (len(members) <= leaf or level == 3):
                    want.add(tuple(sorted(members.tolist())))
                elif len(members) > leaf:
                    todo.append((members, np.full(len(members), p)))
    rows = chosen_path._Join(tokens, 3, 85).nodes_below(large, tokens, leaf, 3).collect()
    found = {}
    for r in rows:
        found.setdefault(r.node, []).append(r.id)
        assert r.component == r.id
    assert {tuple(sorted(ids)) for ids in found.values()} == want and len(found) == len(want) > 3
    assert all(r.size == len(found[r.node]) for r in rows)


def test_ids_are_read_where_they_lie():
    import numpy as np

    ids, ends = np.array([5, 6, 7], "<u4"), np.array([3, 4, 6])
    body = token_files.with_ends(ids, ends, 1, "<u2")
    assert body.tolist() == [5, 6, 1, 1, 7, 1] and body.dtype == np.dtype("<u2")
    column = pa.array([b"\x09\x00", b"\x05\x00\x06\x00\x01\x00", b"\x01\x00"], pa.binary()).slice(1, 2)
    cuts, values = token_files.binary_values(column, "<u2")
    assert cuts.tolist() == [0, 3, 4] and values.tolist() == [5, 6, 1, 1]
    assert not values.flags.owndata


def test_units_are_not_made_into_strings_one_by_one(monkeypatch):
    whole = bpe.Encoder({}, lambda many: [len(u).to_bytes(4, "little") for u in many])
    run = list(whole(pa.array(["one thrée", None, "a'b  one"])))
    assert [(row, end, ids.tolist(), list(offsets)) for row, end, ids, offsets in run] == [(0, 3, [3, 5, 3, 3], [0, 2, 2, 4])]
    plain = []

    class Watched:
        def __getattr__(self, name):
            return getattr(units, name)

        def to_pylist(self):
            plain.append(1)
            return units.to_pylist()

    units = pa.array(["u"], pa.large_string())

    class Coded:
        dictionary, indices = Watched(), pa.array([0], pa.int32())

    class Made:
        def dictionary_encode(self):
            return Coded

    class Arrays:
        from_buffers = staticmethod(lambda *_: Made())

    monkeypatch.setattr(bpe.pa, "LargeStringArray", Arrays)
    assert whole._plain(np_bytes(b"u"), np_offsets(0, 1))[0].tolist() == [1] and not plain


def np_bytes(data):
    import numpy as np

    return np.frombuffer(data, np.uint8)


def np_offsets(*at):
    import numpy as np

    return np.array(at)
