"""Corpus operators against brute force, on small rows with every odd case, and the pipeline."""

import inspect
import math
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgertide.llm import common, ctw, exact, jaccard, langid, substring, topk
from tests.conftest import SF
from tests.llm.conftest import ROWS


def parquet(spark, name="documents"):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize(("query", "sql", "table"), [
    (substring.op6_block_anchors, substring.OP6_SQL, "documents"), (topk.op8_threshold_top_k, topk.OP8_SQL, "embeddings"),
    (exact.op9_block_naming, exact.OP9_SQL, "documents")])
def test_query_equals_its_twin(spark, duck, query, sql, table):
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(tuple(r[n] for n in names) for r in query(parquet(spark, table)).collect()) == sorted(result.fetchall())


def test_exact_groups_of_odd_rows(docs, none):
    rows = exact.exact_groups(docs, block_bytes=16).collect()  # many rounds of naming
    fold = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    sizes = Counter(fold(r[1]) for r in ROWS)
    assert sorted(r.group_size for r in rows) == sorted(sizes[fold(r[1])] for r in ROWS)
    assert sum(r.kept for r in rows) == len(sizes)
    assert all(r.keep_id == 2 for r in rows if r.doc_id in (1, 2))
    assert exact.one_per_group(docs).count() == len(sizes) and exact.one_per_group(docs).columns == docs.columns
    assert exact.exact_groups(none).count() == 0


def test_removed_passages_of_odd_rows(docs, none):
    rows = substring.remove_repeats(docs, block_bytes=2000, shard_bytes=5000).collect()
    assert len(rows) == len(ROWS)
    assert [r.n_removed for r in rows if r.doc_id == 6] == [0]
    assert sorted(r.n_removed for r in rows if r.doc_id == 7) == [60, 63]  # the passage of 6; then the whole repeated row
    assert {(r.n_words, r.kept_text) for r in rows if r.doc_id in (3, 4)} == {(0, "")}
    assert substring.remove_repeats(none).count() == 0


def test_similarity_of_odd_rows(docs, none):
    rows = jaccard.similarity_classes(docs, tile=2).collect()
    words = [(r[1] or "").lower().split() for r in ROWS]
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    want = [(r[0], sum(k != j and bool(x) and len(x & y) >= 0.8 * len(x | y) - 1e-9 for j, y in enumerate(sets)))
            for k, (r, x) in enumerate(zip(ROWS, sets, strict=True))]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_links)) for r in rows)
    assert len({r.class_row for r in rows if r.doc_id == 7}) == 1
    assert jaccard.one_per_class(docs).count() == len({r.class_row for r in rows})
    assert jaccard.similarity_classes(none).count() == 0


def test_similarity_equals_brute_force(spark):
    rows = {r.doc_id: r for r in jaccard.op3_jaccard_join(parquet(spark)).collect()}
    texts = {r.doc_id: (r.text or "").encode().lower().split() for r in parquet(spark).collect()}
    sets = {d: {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for d, w in texts.items()}
    for a, x in sets.items():
        links = [b for b, y in sets.items() if b != a and x and len(x & y) >= 0.8 * len(x | y) - 1e-9]
        assert rows[a].n_links == len(links)
        assert all(rows[b].class_id == rows[a].class_id for b in links)


def test_pruning_needs_fewer_matches_for_smaller_tolerance():
    strict, loose = (jaccard.least_matches(0.8, t, 160) for t in (1e-9, 1e-2))
    assert all(a[1] <= b[1] for a, b in zip(strict, loose, strict=True)) and loose[-1][1] < 0.8 * 160


def test_languages_of_held_out_texts(spark, docs, none):
    told = langid.op4_language_id(parquet(spark)).join(parquet(spark).select("doc_id", "lang"), "doc_id")
    held = told.where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    model = langid.fit(docs, F.xxhash64("doc_id"))
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert all(got[d].lang_pred == "und" and got[d].score == 0 and got[d].rejected for d in (3, 4, 8))
    assert got[9].lang_pred != "und" and 0 <= got[9].score <= 1
    assert langid.identify(none, langid.fit(none, F.lit(0))).count() == 0


@pytest.mark.parametrize("languages", [("de", "en"), ("de", "en", "es", "fr")])
def test_unlearned_scripts_are_rejected_and_clean_texts_stay(spark, languages):
    docs = parquet(spark).where(F.col("lang").isin(*languages))
    model = langid.fit(docs, F.xxhash64("doc_id"))
    assert model.threshold > 1 / len(languages)
    assert langid.identify(docs, model).where("rejected").isEmpty()
    foreign = spark.createDataFrame([("привет как дела сегодня хорошо",), ("こんにちは世界今日はいい天気",), ("한국어로 쓴 글",)], "text string")
    assert langid.identify(foreign, model).where("NOT rejected").isEmpty()


def test_predictions_do_not_depend_on_neighbours(spark, monkeypatch):
    model = langid.fit(parquet(spark), F.xxhash64("doc_id"))
    texts = [r[1].encode() for r in ROWS if r[1]]
    joined, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    together = model.probabilities(joined, bounds)
    monkeypatch.setattr(langid, "SLICE_BYTES", 500)
    apart = [model.probabilities(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(together, apart, atol=1e-4)


def _weighted(rows, depth):
    """By definition: half the node's own estimate, half the product of its children's."""
    ones, own = 0, 1.0
    for i, (_, bit) in enumerate(rows):
        own *= ((ones if bit else i - ones) + 0.5) / (i + 1)
        ones += bit
    if depth == ctw.DEPTH:
        return own, own
    children = Counter(context[depth] for context, _ in rows)
    return own, (own + math.prod(_weighted([r for r in rows if r[0][depth] == c], depth + 1)[1] for c in children)) / 2


def _chance(rows, context, bit, depth=0):
    """Of the next bit after a context, which goes by its longest suffix that was seen."""
    if not rows:
        return 0.5
    estimate = (sum(b == bit for _, b in rows) + 0.5) / (len(rows) + 1)
    nearer = [r for r in rows if depth < ctw.DEPTH and r[0][depth] == context[depth]]
    if not nearer:
        return estimate
    own, whole = _weighted(rows, depth)
    return own / 2 / whole * estimate + (1 - own / 2 / whole) * _chance(nearer, context, bit, depth + 1)


def _decisions(text):
    """(decision, context with the nearest byte first, bit) of every bit of a text's stream."""
    data = bytes(ctw.DEPTH) + b"".join(w + b" " for w in text.lower().encode().split()) + b"\n"
    for at in range(ctw.DEPTH, len(data)):
        bits = f"{data[at]:08b}"
        for k in range(8):
            yield bits[:k], data[at - ctw.DEPTH:at][::-1], int(bits[k])


def test_context_tree_scores_equal_a_recursive_tree(spark):
    texts = ["the cat sat on the mat", "The hat, the cat", "", "a rat sat on that cat", "zq the", "on the mat sat thé", None, "the cat sat on the mat"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in ctw.score_texts(df, F.col("doc_id") % 2 == 0, block_bytes=30, shard_bytes=40).collect()}
    seen = {}
    for i in range(0, len(texts), 2):
        for place, context, bit in _decisions(texts[i] or ""):
            seen.setdefault(place, []).append((context, bit))
    for i, text in enumerate(texts):
        right = sum(math.log10(_chance(seen.get(p, []), c, b)) for p, c, b in _decisions(text or ""))
        assert math.isclose(got[i], right, rel_tol=1e-9), (i, got[i], right)


def test_context_tree_is_a_probability_and_base_is_exact(spark, docs, none):
    kind = ctw.score_texts(docs, F.col("doc_id") % 2 == 1, block_bytes=3000, shard_bytes=20_000).collect()
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    counts = Counter(w for r in ROWS if r[0] and r[0] % 2 for w in tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    assert len(kind) == len(ROWS)
    for r in kind:
        words = tokens(r.text)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(w in counts for w in words), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    grams, unit = ctw.grams_of([b"\0ab", b"\0"], ctw.DEPTH)
    assert len(grams) == 4 and unit.tolist() == [0, 0, 0, 1]
    deep = ctw.deep_levels(grams, np.ones(4), ctw.DEPTH)
    keys, which = np.unique(deep[0].parents(), return_inverse=True)
    top = ctw.top_levels(keys, *[np.bincount(which, x) for x in (deep[0].zeros, deep[0].ones, deep[0].weighted)])
    every = (grams[1] & ~np.uint64(255)) | np.arange(256, dtype=np.uint64)
    assert math.isclose(np.exp(ctw.chances(every, [*top, *deep])).sum(), 1, rel_tol=1e-9)
    assert ctw.score_texts(none, F.lit(True)).count() == 0


def test_contexts_run_across_words(spark, monkeypatch):
    learned = [(i, "ab cd ef gh ij kl " * 20) for i in range(1, 9, 2)]
    df = spark.createDataFrame([*learned, (0, "ab cd ef gh ij kl"), (2, "kl ef ab ij cd gh")], "doc_id bigint, text string")
    fluent, shuffled = (r.score for r in ctw.score_texts(df, F.col("doc_id") % 2 == 1).where("doc_id % 2 = 0").orderBy("doc_id").collect())
    assert fluent > shuffled + 1  # the same words: only contexts that span a blank tell them apart
    grams, stream = ctw.grams_of([ctw.stream_of(b"Ab c"), ctw.stream_of(b"")], 6)
    assert [int(g).to_bytes(8, "big") for g in grams[-2:]] == [b" c ba\0\0\n", b"\0\0\0\0\0\0\0\n"] and stream.tolist() == [0] * 6 + [1]
    monkeypatch.setattr(ctw, "WINDOW", 2)
    assert all((a == b).all() for a, b in zip((grams, stream), ctw.grams_of([ctw.stream_of(b"Ab c"), ctw.stream_of(b"")], 6), strict=True))


def test_paths_by_runs_equal_paths_by_search():
    grams, counts = ctw._counted_grams([ctw.stream_of(t) for t in (b"the cat sat on the mat", b"the hat", b"", b"a" * 70)], 6)
    counts = np.where(np.arange(len(counts)) % 3 == 0, 0, counts)  # a third occurs in no training text
    learnt, times = grams[counts > 0], counts[counts > 0]
    for k in range(8):
        deep = ctw.deep_levels(learnt, times, 6, [k])
        keys = deep[0].parents()
        top = ctw.top_levels(keys, deep[0].zeros, deep[0].ones, deep[0].weighted)
        assert np.allclose(ctw.chances_by_runs(grams, counts, 6, top, k), ctw.chances(grams, [*top, *deep], [k]), rtol=1e-12, atol=1e-12)
    every = [g for g, _ in ctw.windows([b"\0" + b"ab " * 900_000], 6)]
    assert len(every) > 2 and sum(map(len, every)) == 2_700_001  # over several windows no byte is lost


def test_each_node_meets_at_the_top_once():
    grams, _ = ctw.grams_of([ctw.stream_of(b"the cat sat on the mat")], 6)
    parts = [ctw.to_the_top(6)(ctw.table(ctw.ASKED, [(0, "gram", 0, ctw.packed(g), ctw.packed(np.ones(len(g), "<u4")))]))
             for g in map(np.unique, (grams[::2], grams[1::2]))]
    for k in range(8):
        both = ctw.pa.concat_tables([p.filter(ctw.pa.array([x == k for x in p["k"].to_pylist()])) for p in parts])
        (keys, *sums), (every, *values) = ctw.joined(ctw.meet_at_the_top(both)), ctw.joined(both)
        assert len(keys) == len(np.unique(every)) < len(every) and (np.diff(keys.astype(np.int64)) > 0).all()
        assert all(math.isclose(a.sum(), b.sum()) for a, b in zip(sums, values, strict=True))


def test_top_k_of_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [0.0, 0.0]),
            (6, [5.0]), (None, [9.0, 9.0]), (1, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = topk.exact_top_k(df, df.where("vec_id = 0"), k=4, block_rows=2, query_rows=1).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 5 * 256**2), (1, 5 * 256**2), (6, 5 * 256**2), (5, 0)]
    assert topk.exact_top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_of_large_vectors_is_exact_or_fails(spark):
    rows = [(0, [1.0, -1.0]), (1, [2.0**23, 0.0]), (2, [2.0**40, 1.0]), (3, [float("inf"), 1.0]), (4, [0.0, -(2.0**40)])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = topk.exact_top_k(df, df.where("vec_id = 0"), k=4).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(4, 2**56), (2, 2**56 - 2**16), (1, 2**39)]
    wide = spark.createDataFrame([(0, [2.0**23, 2.0**23]), (1, [-(2.0**23), 2.0**23]), (2, [-(2.0**24), 1.0]), (3, [-(2.0**25), -(2.0**25)])],
                                 "vec_id bigint, embedding array<double>")  # products pass a long, the best scores do not
    got = topk.exact_top_k(wide, wide.where("vec_id = 0"), k=2).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 0), (2, (1 - 2**24) * 2**39)]
    for large in (2.0**25, 2.0**60):  # a score, then a component
        beyond = spark.createDataFrame([(0, [large]), (1, [large * 2])], "vec_id bigint, embedding array<double>")
        with pytest.raises(Exception, match="(?i)long|overflow|too (big|large)"):
            topk.exact_top_k(beyond, beyond, k=1).collect()


def test_pipeline_keeps_clean_documents_and_columns(spark):
    import corpus_pipeline as pipeline

    docs, columns = parquet(spark), parquet(spark).columns
    for name, stage in pipeline.STAGES:
        before = docs.count()
        docs = pipeline.stored(stage(spark, docs, SF), "test")
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == columns and 0.8 * before <= docs.count() <= before
    assert docs.where("length > 4096 or offset + length > 4096").isEmpty()


def thue_morse(bits, one="a", two="b"):
    return "".join(two if bin(i).count("1") % 2 else one for i in range(2**bits))


def test_structured_words_do_not_collide(spark):
    """A word over two letters and its complement: powers of one base modulo 2**64 take both for the same."""
    word, other = thue_morse(10), thue_morse(10, "b", "a")
    rest = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"{rest} {word} {rest}"), (2, f"{rest} {other} {rest}"), (3, word), (4, other)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring.op6_block_anchors(docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
    alone = jaccard.op3_jaccard_join(docs.where("doc_id > 2")).collect()
    assert {(r.class_id, r.n_links) for r in alone} == {(3, 0), (4, 0)}


def test_rows_made_from_one_row_are_told_apart(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(10, ["same", "only here"]), (20, ["same", "other"])], "doc_id long, texts array<string>").coalesce(1).write.parquet(path)
    rows = spark.read.parquet(path).select(F.explode("texts").alias("text"), "doc_id").withColumn(
        "doc_id", F.col("doc_id") + F.when(F.col("text") == "same", 0).otherwise(1))
    left = exact.one_per_group(rows).collect()
    assert sorted((r.doc_id, r.text) for r in left) == [(11, "only here"), (20, "same"), (21, "other")]
    twice = spark.createDataFrame([(1, "x"), (1, "x")], "doc_id long, text string")
    assert exact.one_per_group(twice).count() == 1


CLASHES = ["score", "Rejected", "lang_pred", "n_words", "Kept_Text", "__text", "__row", "row", "carried", "c0", "n_tokens"]


def test_columns_of_any_name_come_out_of_every_stage(spark, docs):
    import corpus_pipeline as P

    wide = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    for i, name in enumerate(CLASHES):
        wide = wide.withColumn(name, F.lit(f"mine{i}"))
    wide = P.stored(wide, "wide")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"mine{i}" for r in rows for i, c in enumerate(CLASHES)), name


def test_blocks_give_their_memory_back_when_they_are_done(monkeypatch):
    given = []
    monkeypatch.setattr(common, "unused_returned", lambda: given.append(len(given)))
    one, two = common.frugal(lambda a: (a, len(given))), common.frugal(lambda a, b: (a, b, len(given)))
    assert one("a") == ("a", 1) and two("a", "b") == ("a", "b", 3) and len(given) == 4
    assert [f.__code__.co_argcount for f in (one, two)] == [1, 2]  # by which Spark calls them
    source = inspect.getsource(substring.remove_repeats) + inspect.getsource(ctw.score_texts)
    assert source.count("applyInArrow(") == source.count("applyInArrow(frugal(") == 11


def test_levels_come_one_by_one_deepest_first():
    grams = np.sort(np.random.default_rng(1).integers(0, 2**63, 50).astype(np.uint64))
    times = np.arange(50.0) + 1
    for k in range(8):
        steps = ctw.levels_up(grams, times, 6, [k])
        assert iter(steps) is steps  # not held as a list
        for a, b in zip(list(steps)[::-1], ctw.deep_levels(grams, times, 6, [k]), strict=True):
            assert (a.keys == b.keys).all() and (a.weighted == b.weighted).all() and (a.zeros == b.zeros).all()


def test_a_shard_is_worked_off_in_parts_that_share_no_context(monkeypatch):
    rng = np.random.default_rng(2)
    grams = [np.unique(rng.integers(0, 5, (400, 8)).astype(np.uint8).view(">u8").ravel().astype(np.uint64)) for _ in range(3)]
    grams = [np.unique(g & np.uint64(2**64 - 2**16) | g & np.uint64(255)) for g in grams]
    rows = [(b, "gram", 0, ctw.packed(g), ctw.packed(rng.integers(0, 4, len(g)).astype("<u4"))) for b, g in enumerate(grams)]
    asked = ctw.table(ctw.ASKED, rows)

    class Top:
        value = ctw.top_levels(*[np.concatenate([a for a in x]) for x in zip(*[ctw.joined(ctw.to_the_top(6)(asked))], strict=True)])

    whole = [ctw.to_the_top(6)(asked).to_pylist(), ctw.tell_chances(6, Top)(asked).to_pylist()]
    parts, own = [], ctw.context_slices
    monkeypatch.setattr(ctw, "GRAMS_AT_ONCE", 20)
    monkeypatch.setattr(ctw, "context_slices", lambda g: (parts.append(p) or p for p in own(g)))
    small = [ctw.to_the_top(6)(asked).to_pylist(), ctw.tell_chances(6, Top)(asked).to_pylist()]
    assert len(parts) > 10 and max(p.stop - p.start for p in parts) < 120
    for a, b in zip(whole[0], small[0], strict=True):
        assert a["keys"] == b["keys"] and a["zeros"] == b["zeros"] and np.allclose(np.frombuffer(a["below"]), np.frombuffer(b["below"]))
    for a, b in zip(whole[1], small[1], strict=True):
        assert a["block"] == b["block"] and np.allclose(ctw.unpacked(a["answer"], "<f8"), ctw.unpacked(b["answer"], "<f8"))


def test_a_group_in_several_batches_gives_the_same_rows(spark, docs, monkeypatch):
    ask = [lambda: sorted(map(str, substring.op6_block_anchors(docs).collect())),
           lambda: sorted(map(str, ctw.score_texts(docs.select("doc_id", "text"), F.col("doc_id") % 2 == 0).select("doc_id", "n_tokens", F.round("score", 6)).collect()))]
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    whole = [a() for a in ask]
    assert int(spark.conf.get(key)) <= 4 << 20
    spark.conf.set(key, "200")
    assert [a() for a in ask] == whole
    spark.conf.unset(key)


def test_a_block_is_asked_and_scored_in_few_bytes_for_each_of_its_own(monkeypatch):
    rng = np.random.default_rng(3)
    text = b" ".join(rng.integers(97, 123, int(n)).astype(np.uint8).tobytes() for n in rng.integers(3, 9, 80_000))
    monkeypatch.setattr(ctw, "WINDOW", 1 << 16)
    docs = ctw.pa.table({"__text": [text, b"held out " * 9], "__train": [True, False], "__block": ctw.pa.array([0, 0], "int32")})
    size = docs["__text"].nbytes

    def peak(fn, *args):
        tracemalloc.start()
        result = fn(*args)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return result, most / size

    grams, counts = ctw._counted_grams([ctw.stream_of(text)], 6)
    assert peak(ctw._counted_grams, [ctw.stream_of(text)], 6)[1] < 33
    order, parts = ctw._by_context(grams, 7)
    shard = (ctw.mixed(grams >> np.uint64(40)) % np.uint64(7)).astype(int)
    assert (order == np.argsort(shard, kind="stable")).all() and {n: p.stop - p.start for n, p in parts} == Counter(shard.tolist())
    asked = ctw.ask(7, 6)(docs).to_pylist()
    back = {r["shard"]: (ctw.unpacked(r["keys"], "<u8"), ctw.unpacked(r["counts"], "<u4")) for r in asked if r["kind"] == "gram"}
    every, times = ctw.merged([g for g, _ in back.values()], [n for _, n in back.values()])
    other = ctw._counted_grams([ctw.stream_of(b"held out " * 9)], 6)[0]
    assert set(every.tolist()) == {*grams.tolist(), *other.tolist()} and (times[np.searchsorted(every, grams)] == counts).all() and times.sum() == counts.sum()
    answers = {n: ctw.pa.py_buffer(ctw.packed(-np.ones(len(g)))) for n, (g, _) in back.items()}
    scores, most = peak(ctw._gram_scores, docs["__text"].to_pylist(), 7, 6, answers)
    assert np.allclose(scores * ctw.LN10, [-len(ctw.stream_of(t)) for t in docs["__text"].to_pylist()]) and most < 50


def test_a_shards_grams_are_counted_range_by_range(monkeypatch):
    rng = np.random.default_rng(4)
    lists = [(np.unique(rng.integers(0, 2**62, n).astype(np.uint64)), np.ones(n, "<u4")) for n in (900, 500, 0, 1)]
    lists.append((lists[0][0][::3], np.full(300, 2**32 - 1, "<u4")))
    monkeypatch.setattr(ctw, "GRAMS_AT_ONCE", 100)
    spans, every, counts = zip(*ctw._counted(lists), strict=True)
    assert len(every) > 10 and max(map(len, every)) < 400
    want = ctw.merged([g for g, _ in lists], [n.astype(float) for _, n in lists])
    assert (np.concatenate(every) == want[0]).all() and (np.concatenate(counts) == want[1]).all()
    for i, (grams, _) in enumerate(lists):
        assert np.concatenate([grams[s[i]] for s in spans]).tolist() == grams.tolist()


def test_numbers_travel_in_few_bytes_and_come_back():
    rng = np.random.default_rng(5)
    for kind in ("<u8", "<u4", "<f8", "<i4"):
        for n in (0, 1, 3000):
            values = np.sort(rng.integers(0, 50, n)).astype(kind)
            data = common.packed(values)
            assert common.unpacked(data, kind).tolist() == values.tolist()
            assert common.unpacked(common.pa.py_buffer(data), kind).tolist() == values.tolist()
            assert n < 3000 or len(data) < values.nbytes / 10


def test_a_sample_comes_to_the_driver_in_few_bytes(spark, monkeypatch):
    sent, given, own = [], [], langid.unpacked
    monkeypatch.setattr(langid, "unpacked", lambda data, kind: (sent.append((len(data), own(data, kind))), sent[-1][1])[1])
    monkeypatch.setattr(langid, "unused_returned", lambda: given.append(len(sent)))
    model = langid.fit(parquet(spark), F.xxhash64("doc_id"))
    assert given == [len(sent)] and 2 * sum(n for n, _ in sent) < sum(a.nbytes for _, a in sent)
    rows = {(a.tobytes(), n.tobytes()) for (_, a), (_, n) in zip(sent[::2], sent[1::2], strict=True)}
    texts = [r.text.encode() for r in parquet(spark).select("text").collect() if r.text]
    assert rows <= {tuple(x.tobytes() for x in langid.counted(t)) for t in texts} and len(model.languages) > 1


def test_a_settled_shard_tells_what_it_would_have_told():
    grams = [ctw._counted_grams([ctw.stream_of(t)], 6)[0] for t in (b"the cat sat on the mat", b"the hat")]
    asked = ctw.table(ctw.ASKED, [(b, "gram", 3, ctw.packed(g), ctw.packed(np.ones(len(g), "<u4"))) for b, g in enumerate(grams)])
    settled = ctw.settle(6)(asked)
    whole = ctw.to_the_top(6)(asked)
    assert settled.slice(0, 8).select(whole.column_names).to_pylist() == whole.to_pylist() and set(settled["shard"].to_pylist()) == {3}

    class Top:
        value = ctw.top_levels(*ctw.joined(whole))

    told = ctw.pa.Table.from_batches(ctw.tell_settled(6, Top)(settled.slice(8).combine_chunks().to_batches()))
    assert len(settled) == 9 and told.to_pylist() == ctw.tell_chances(6, Top)(asked).to_pylist()


def test_texts_go_to_their_blocks_once_and_come_back_whole(spark, docs, monkeypatch):
    dealt, own = [], type(docs).groupBy
    monkeypatch.setattr(type(docs), "groupBy", lambda self, *c: (dealt.append((c, dict(self.dtypes))), own(self, *c))[1])
    scored = ctw.score_texts(docs, F.col("doc_id") % 2 == 1, block_bytes=3000, shard_bytes=20_000)
    want = sorted(docs.collect(), key=str)
    assert scored.columns[:4] == docs.columns and sorted(scored.select(docs.columns).collect(), key=str) == want
    sent = [kinds for by, kinds in dealt if by == ("__block",)]
    assert [(kinds["__text"], kinds.get("text")) for kinds in sent] == [("binary", None), ("binary", "boolean")]
    assert sum(by == ("shard",) for by, _ in dealt) == 2  # words and grams go to their shards once each
