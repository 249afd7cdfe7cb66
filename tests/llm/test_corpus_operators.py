import random
import zlib

import numpy as np
import pytest
import xxhash
from odd import TEXTS, odd_docs
from pyspark.sql import functions as F

import corpus_pipeline
from weekmart.llm import components, language, quality, queries, shards, simhash, skew, topk

SF = "/root/testdata/sf0.001"


def grouped(nodes, near):
    """Smallest member of each node's group, by plain search."""
    root = {}
    for start in sorted(nodes):
        if start in root:
            continue
        queue = [start]
        while queue:
            here = queue.pop()
            if here not in root:
                root[here] = start
                queue += [n for n in nodes if n not in root and near(here, n)]
    return root


# --- top-k ---------------------------------------------------------------------------------------

def plain_top(rows, k):
    size = max((len(v) for i, v in rows if v is not None), default=0)
    held = [(i, list(v) + [0] * (size - len(v))) for i, v in rows if i is not None and v is not None and None not in v]
    asked = {}
    for i, v in sorted(held):
        if i % 50 == 0:
            asked.setdefault(i, v)
    out = []
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in held if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def top(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, "clash", 1.0) for i, v in rows], "vec_id long, vector array<long>, id string, score double")
    return sorted(tuple(r) for r in topk.exact_top_k(df, F.col("vec_id") % 50 == 0, k).collect())


@pytest.mark.parametrize("spread", [1, 3, 400])
def test_scores_equal_all_products(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "CHUNK_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    monkeypatch.setattr(topk, "GROUP_CHUNKS", 2)
    monkeypatch.setattr(topk, "GROUP_BLOCKS", 2)
    monkeypatch.setattr(topk, "SEED_ROWS", 30)
    rng = np.random.default_rng(spread)
    rows = [(i, (rng.integers(-spread, spread + 1, 12) * rng.integers(1, 9)).tolist()) for i in range(700)]
    rows += [(3, rows[3][1]), (100, [0] * 12), (None, rows[0][1]), (701, None), (702, [1, None]), (703, [5, 5]), (704, []), (-50, rows[9][1])]
    assert top(spark, rows) == plain_top(rows, 5)


def test_few_large_or_no_vectors(spark):
    assert top(spark, []) == [] and top(spark, [(50, [1])]) == [] and top(spark, [(1, None)]) == []
    assert top(spark, [(50, [2]), (1, [3]), (2, [-1])]) == [(50, 1, 1, 6), (50, 2, 2, -2)]
    wide = [(0, [2**30, 3]), (1, [2**30, 1]), (2, [2**30 + 1, -7])]
    assert top(spark, wide) == plain_top(wide, 5)
    assert top(spark, [(0, [2**62]), (1, [2**62])]) == [(0, 1, 1, 2**63 - 1)]


def test_vectors_with_odd_components_are_left_out(spark):
    df = spark.createDataFrame(
        [(1, [0.5, -0.25]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, [None, 1.0]), (5, None), (6, []), (7, [0.999, -0.001])],
        "vec_id long, embedding array<float>")
    found = {r[0]: r[1] for r in df.select("vec_id", topk.quantised(F.col("embedding"))).collect()}
    assert found == {1: [128, -64], 2: None, 3: None, 4: None, 5: None, 6: [], 7: [255, -1]}


# --- SimHash -------------------------------------------------------------------------------------

def plain_fingerprint(content, shingle=4):
    words = (content or "").encode().lower().split()
    pieces = [b" ".join(words[k: k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_fingerprints_equal_the_definition():
    for content in [*TEXTS, "a b c", "a b c d", "A B C D E e e e e e e e", "x " * 600, "é\u0085ü  b\x0bc\x1cd e f"]:
        assert simhash.fingerprint((content or "").encode()) == plain_fingerprint(content)


@pytest.mark.parametrize("max_bits", range(7))
def test_near_fingerprints_share_a_variant(spark, max_bits):
    random.seed(max_bits)
    pairs = []
    for _ in range(300):
        a = random.getrandbits(64)
        b = a
        for bit in random.sample(range(64), random.randint(0, max_bits)):
            b ^= 1 << bit
        pairs.append([x - (1 << 64) if x >> 63 else x for x in (a, b)])
    df = spark.createDataFrame(pairs, "a long, b long")
    keys = simhash.variants(max_bits)
    one = df.select("a", "b", F.col("a").alias("fp")).select("a", "b", keys.alias("x"))
    both = one.select("x", F.col("b").alias("fp")).select("x", keys.alias("y"))
    assert both.where(~F.arrays_overlap("x", "y")).count() == 0
    assert sum(w for _, w, _ in simhash.segments(max_bits)) == 64


@pytest.mark.parametrize("bucket", [1024, 3])
def test_components_of_fingerprints_equal_all_pairs(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    random.seed(8)
    prints = {0, (1 << 64) - 1, 1, 3, 7, 15, 31}
    for _ in range(12):
        here = random.getrandbits(64)
        for _ in range(25):
            prints.add(here)
            for bit in random.sample(range(64), random.randint(1, 6)):
                here ^= 1 << bit
    centre = random.getrandbits(64)
    prints |= {centre ^ (1 << a) ^ (1 << b) for a in range(10) for b in range(10, 20)}
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    found = {r["node"]: r["root"] for r in components.connected_components(links).collect()}
    expected = grouped(signed, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4)
    assert {p: found.get(p, p) for p in signed} == expected
    assert all(((r["a"] ^ r["b"]) & ((1 << 64) - 1)).bit_count() <= 4 for r in links.collect())


@pytest.mark.parametrize("max_bits", [0, 1, 3, 4])
def test_divided_buckets_lose_no_link(spark, monkeypatch, max_bits):
    monkeypatch.setattr(simhash, "BUCKET", 4)
    monkeypatch.setattr(simhash, "WIDE", 2)
    random.seed(max_bits)
    segment, bits = simhash.segments(max_bits)[-1], []  # many that share the last segment, some of them near
    low, width, _ = segment
    fixed = random.getrandbits(width) << low
    for _ in range(60):
        here = random.getrandbits(64) & ~(((1 << width) - 1) << low) | fixed
        bits.append(here)
        for _ in range(2):
            for bit in random.sample([k for k in range(64) if not low <= k < low + width] or [0], max(max_bits, 1) if width < 64 else 0):
                here ^= 1 << bit
            bits.append(here)
    signed = {p - (1 << 64) if p >> 63 else p for p in bits}
    prints = spark.createDataFrame([(p,) for p in signed], "fp long")
    calls, plain = [], simhash.divided

    def spy(keys, wide, limit):
        split = plain(keys, wide, limit)
        calls.append((wide.count(), keys.count() - split.count()))
        return split

    monkeypatch.setattr(simhash, "divided", spy)
    found = {r["node"]: r["root"] for r in components.connected_components(simhash.near_links(prints, max_bits)).collect()}
    expected = grouped(signed, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= max_bits)
    assert {p: found.get(p, p) for p in signed} == expected
    assert max_bits < 3 or (calls and calls[0][0] and calls[0][1])


def test_hot_keys_are_joined_like_others(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    monkeypatch.setattr(skew, "HOT_KEYS", 2)
    rows = [(None if k == 9 else k, i) for k in range(10) for i in range(k * 3)]
    df = spark.createDataFrame(rows, "k int, i int")
    table = df.groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("top"))
    found = skew.join_by_size(df, table, "k", "n").select("k", "i", "n", "top")
    assert sorted(tuple(r) for r in found.collect()) == sorted((k, i, k * 3, k * 3 - 1) for k, i in rows if k is not None)


def test_components_of_stars_chains_and_nothing(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(300)] + [(7, 7), (None, 3), (50, 49), (49, 50)]
    found = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[k] for k in range(41)} == {0} and {found[200 + k] for k in range(300)} == {100} and found[50] == 49 and len(found) == 41 + 301 + 2
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_odd_documents(spark):
    docs = odd_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    prints = {t: plain_fingerprint(t) for _, t in rows}
    root = grouped(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    smallest = {}
    for i, t in rows:
        if i is not None:
            smallest[root[prints[t]]] = min(i, smallest.get(root[prints[t]], i))
    found = simhash.near_duplicates(docs)
    assert sorted(((r[0], r[1] % (1 << 64), r[2]) for r in found.collect()), key=str) == sorted(
        ((i, prints[t], smallest.get(root[prints[t]])) for i, t in rows), key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {root[p] for p in prints.values()}
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((smallest.get(g) for g in groups), key=str)
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_repeated_rows_of_one_id_leave_one(spark):
    same = "some words that are all the same here"
    docs = spark.createDataFrame([(1, same), (1, same), (1, "quite another text with other words in it"), (2, same), (None, "z"), (None, "z")], "doc_id long, text string")
    assert sorted((tuple(r) for r in simhash.keep_one(docs).collect()), key=str) == sorted(
        [(1, same), (1, "quite another text with other words in it"), (None, "z")], key=str)


# --- language ------------------------------------------------------------------------------------

def kneser_ney(grams, counts):
    """The whole model in plain numpy, from distinct 4-grams and their counts."""
    tables, counts = [], counts.astype(float)
    for size in range(4, 0, -1):
        once, twice = (counts == 1).sum(), (counts == 2).sum()
        less = once / (once + 2 * twice) if once and twice else 0.5
        order = np.argsort(grams)
        grams, counts = grams[order], counts[order]
        contexts, first, kinds = np.unique(grams >> np.uint64(16), return_index=True, return_counts=True)
        totals = np.add.reduceat(counts, first)
        tables.append(language.Table(grams, np.maximum(counts - less, 0) / np.repeat(totals, kinds), contexts, min(less, 1) * kinds / totals))
        if size > 1:
            grams, counts = np.unique(grams & np.uint64((1 << 16 * (size - 1)) - 1), return_counts=True)
            counts = counts.astype(float)
    return language.LanguageModel(tables[::-1], 1 / (len(grams) + 1))


def test_probabilities_are_a_distribution_and_as_defined():
    words = ["abab", "abc", "b", "cab", "aab"]
    points = np.array([ord(c) for c in "\n".join(words)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    keys, _ = language.word_grams(points, starts, ends)
    grams, counts = np.unique(keys, return_counts=True)
    model = kneser_ney(grams, counts)
    symbols = [ord("a"), ord("b"), ord("c"), language.END]

    def packed(context, symbol):
        return sum(c << 16 * k for k, c in enumerate([symbol, *context[::-1]]))

    for context in ([1, 1, 1], [1, ord("a"), ord("b")], [ord("z"), ord("z"), ord("a")], [ord("z")] * 3):
        asked = np.array([packed(context, s) for s in symbols], np.uint64)
        assert np.exp(language.log_probabilities(model, asked)).sum() == pytest.approx(1 - model.unseen, abs=0.25)

    def plain(context, symbol, size=4):
        if size == 0:
            return model.unseen
        level = {}
        full = {}
        for g, n in zip(grams.tolist(), counts.tolist()):
            full[tuple(g >> 16 * k & 0xFFFF for k in range(3, -1, -1))] = n
        level = full
        for _ in range(4 - size):
            shorter = {}
            for g in level:
                shorter[g[1:]] = shorter.get(g[1:], 0) + 1
            level = shorter
        once, twice = sum(n == 1 for n in level.values()), sum(n == 2 for n in level.values())
        discount = once / (once + 2 * twice) if once and twice else 0.5
        head = tuple(context[len(context) - size + 1:]) if size > 1 else ()
        total = sum(n for g, n in level.items() if g[:-1] == head)
        lower = plain(context, symbol, size - 1)
        if not total:
            return lower
        kinds = sum(g[:-1] == head for g in level)
        return max(level.get(head + (symbol,), 0) - discount, 0) / total + min(discount, 1) * kinds / total * lower

    for context in ([1, 1, 1], [1, 1, ord("a")], [ord("c"), ord("a"), ord("b")], [ord("z"), ord("a"), ord("b")]):
        for symbol in symbols + [ord("q")]:
            got = np.exp(language.log_probabilities(model, np.array([packed(context, symbol)], np.uint64)))[0]
            assert got == pytest.approx(plain(context, symbol), rel=1e-9)


def test_languages_of_held_out_documents(spark):
    rows = queries.op6_language(spark, SF).collect()
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(langs) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows) and sum(r["rejected"] for r in rows if not r["held_out"]) <= 4


def test_odd_texts_have_a_defined_language(spark):
    train = spark.createDataFrame([("the cat sat on the mat", "en"), ("der hund und die katze", "de"), (None, "fr"), ("le chat", None)], "text string, lang string")
    models = list(language.train(train))
    assert len(models) == 1 and sorted(models[0].models) == ["de", "en"]
    docs = odd_docs(spark)
    told = language.identify(docs, models).collect()
    assert all((r["prediction"]["lang"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) for r in told)
    assert told[0]["prediction"]["score"] == 0 and told[0]["prediction"]["entropy"] is None
    assert language.identify(spark.createDataFrame([("Die Katze und der Hund",)], "text string"), models).first()["prediction"]["lang"] == "de"
    none = list(language.train(train.limit(0)))
    assert not none[0].models and language.identify(docs, none).first()["prediction"]["lang"] == "und"
    assert language.identify(docs.limit(0), models).count() == 0
    silent = list(language.train(spark.createDataFrame([("12 34", "xx")], "text string, lang string")))
    assert not silent[0].models and language.identify(docs, silent).first()["prediction"]["lang"] == "und"


def test_blocks_of_models_give_what_whole_models_give(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    whole, cut = list(language.train(docs)), list(language.train(docs, block_grams=2000))
    assert len(whole) == 1 and len(cut) > 4
    assert [b.high for b in cut[:-1]] == [b.low for b in cut[1:]] and (cut[0].low, cut[-1].high) == (0, language.SYMBOLS)
    counted = language.gram_counts(docs)
    dealt = language.interpolated(counted)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in dealt and "SortMergeJoin" not in dealt  # never dealt out by language alone
    grams = counted.toArrow().to_pandas()
    for name, part in grams.groupby("lang"):
        plain = kneser_ney(part["gram"].to_numpy().view(np.uint64), part["n"].to_numpy())
        for block in cut:
            keys = block.models[name].tables[-1].grams
            assert np.allclose(language.log_probabilities(block.models[name], keys), language.log_probabilities(plain, keys), rtol=1e-12)
        assert sum(len(block.models[name].tables[-1].grams) for block in cut) == len(part)
    one, many = (
        {r["doc_id"]: r["prediction"] for r in language.identify(docs, m).drop("text").collect()} for m in (whole, cut))
    assert one.keys() == many.keys()
    for id, told in one.items():
        assert (told["lang"], told["symbols"]) == (many[id]["lang"], many[id]["symbols"])
        assert told["entropy"] is None or told["entropy"] == pytest.approx(many[id]["entropy"], rel=1e-9)
        assert told["score"] == pytest.approx(many[id]["score"], rel=1e-9)
    plan = language.identify(docs, cut)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_rejection_needs_texts_enough_to_tell(spark):
    told = [("en", ("en", k / 1000)) for k in range(1000)] + [("de", ("de", 1.0))] * 199 + [("en", ("de", 9.0))] * 50 + [("fr", ("und", None))] * 900
    rows = spark.createDataFrame(told, "lang string, prediction struct<lang: string, entropy: double>")
    assert {r["lang"]: r["limit"] for r in language.rejection_limits(rows).collect()} == {"en": pytest.approx(0.994, abs=1e-3)}


# --- shards --------------------------------------------------------------------------------------

def test_matrix_has_exact_sums_and_the_hypergeometric_law():
    rows, sizes = [50, 0, 30, 20], [40, 35, 25]
    total = np.zeros((4, 3))
    for seed in range(2000):
        matrix = shards.communication_matrix(rows, sizes, seed)
        assert matrix.sum(1).tolist() == rows and matrix.sum(0).tolist() == sizes and (matrix >= 0).all()
        total += matrix
    assert np.allclose(total / 2000, np.outer(rows, sizes) / 100, atol=0.25)


def test_draws_beyond_the_library_keep_the_law(monkeypatch):
    monkeypatch.setattr(shards, "LARGEST_DRAW", 0)
    rng = np.random.default_rng(1)
    draws = [shards.draw_hypergeometric(rng, 300, 700, 100) for _ in range(4000)]
    assert np.mean(draws) == pytest.approx(30, abs=0.3) and np.var(draws) == pytest.approx(100 * 0.3 * 0.7 * 900 / 999, rel=0.1)
    assert shards.draw_hypergeometric(rng, 0, 5, 3) == 0 and shards.draw_hypergeometric(rng, 5, 0, 3) == 3
    assert 0 < shards.draw_hypergeometric(rng, 10**12, 10**12, 10**6) < 10**6


def test_shards_have_exact_sizes_and_whole_slots(spark, monkeypatch):
    monkeypatch.setattr(shards, "SLOT_ROWS", 10)
    docs = odd_docs(spark).repartition(3)
    rows = docs.union(docs).union(docs)
    found = shards.uniform_shards(rows, 4)
    assert [c for c in found.columns if c not in ("shard", "slot")] == [c for c in docs.columns if c not in ("shard", "slot")]
    got = found.select("shard", "slot", "doc_id").collect()
    count = rows.count()
    for k in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(count // 4 + (k < count % 4)))
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in rows.collect())
    assert shards.uniform_shards(docs.limit(0), 4).count() == 0


def test_every_document_may_come_to_any_slot(spark):
    docs = spark.range(0, 40, 1, 4)
    places = np.zeros((40, 2))
    for seed in range(30):
        for r in shards.uniform_shards(docs, 2, seed * 7).collect():
            places[r["id"], r["shard"]] += 1
    assert places.min() >= 4 and places.sum(0).tolist() == [600, 600]


def test_op7_columns(spark):
    rows = queries.op7_sharding(spark, SF).collect()
    docs = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {i: (len(t) + 1, zlib.crc32(t)) for i, t in docs.items()}
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}


# --- quality -------------------------------------------------------------------------------------

def test_votes_equal_a_plain_neighbour_search():
    rng = np.random.default_rng(4)
    vectors, asked = (rng.standard_normal((n, 8)).astype(np.float32) for n in (200, 30))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    asked /= np.linalg.norm(asked, axis=1, keepdims=True)
    labels = rng.integers(0, 2, 200).astype(float)
    model = quality.QualityModel(np.ones(1), np.ones((1, 1)), vectors, labels)
    for row, got in zip(asked, model.vote(asked)):
        near = sorted(((max(float(np.float32(row @ v)), 0), y) for v, y in zip(vectors, labels)), reverse=True)[: quality.NEIGHBOURS]
        weights = [s**quality.SHARPNESS for s, _ in near]
        expected = (sum(w * y for w, (_, y) in zip(weights, near)) + quality.PRIOR_WEIGHT * labels.mean()) / (sum(weights) + quality.PRIOR_WEIGHT)
        assert got == pytest.approx(expected, rel=1e-3)


def test_document_frequencies_cover_all_texts(spark):
    docs = odd_docs(spark)
    frequencies, count = quality.document_frequencies(docs)
    texts = [(r["text"] or "").encode() for r in docs.collect()]
    plain = sum((quality.term_counts(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] > 0).astype(int) for t in texts)
    assert count == len(texts) and (frequencies == plain).all()


def test_quality_does_not_depend_on_the_order_of_rows(spark):
    rows = [(k % 40, f"text {k} of words {k * 7 % 11}", k % 2) for k in range(60)] + [(None, "x", 1), (5, None, 1)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:40]], "doc_id long, quality int")
    one, two = (quality.fit(docs.repartition(n, "text"), labels.repartition(n), sample=25) for n in (1, 5))
    assert one.vectors.shape[0] == 25 and (one.vectors == two.vectors).all() and (one.labels == two.labels).all()


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op8_quality(spark, folder).collect()
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == y for p, y in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_odd_documents_and_labels_have_a_score(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(3, 1), (3, 1), (4, 0), (5, None), (None, 1), (99, 0), (6, 7), (0, 1)], "doc_id long, quality int")
    scored = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored) and scored[0]["score"] == scored[1]["score"]
    blank = quality.fit(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, blank).collect()} == {0.5}
    empty = docs.limit(0)
    assert quality.score(empty, quality.fit(empty, labels)).count() == 0


# --- pipeline ------------------------------------------------------------------------------------

def test_each_stage_equals_its_operators_brute_force(spark):
    from test_text_operators import PATH, plain_hits
    import tokenizers
    from weekmart.llm import secret_scan

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    scores = {r["doc_id"]: r["predicted"] for r in queries.op8_quality(spark, SF).collect()}
    kept = stages["quality"](spark, docs, SF)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, p in scores.items() if p == 1}
    before = {r["doc_id"]: r["text"] for r in kept.collect()}
    kept = stages["near_duplicates"](spark, kept, SF)
    prints = {i: plain_fingerprint(t) for i, t in before.items()}
    root = grouped(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    first = {}
    for i, p in sorted(prints.items()):
        first.setdefault(root[p], i)
    now = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert set(now) == set(first.values())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = stages["decontamination"](spark, kept, SF)
    clean = {i: t for i, t in now.items() if not (lambda n, h, _: h > 0 and 20 * h >= n)(*plain_hits(t, items, 13))}
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == clean
    kept = stages["secrets"](spark, kept, SF)
    masked = {i: secret_scan._masked(t, secret_scan.find_secrets(t)) for i, t in clean.items()}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept.collect()} == {i: (t, len(t)) for i, t in masked.items()}
    library = tokenizers.Tokenizer.from_file(PATH)
    for r in stages["encoding"](spark, kept, SF).collect():
        assert r["ids"] == library.encode(masked[r["doc_id"]], add_special_tokens=False).ids and r["decodes"] and r["n_tokens"] == len(r["ids"])


def test_stages_stand_odd_and_no_documents(spark):
    for docs in (odd_docs(spark), odd_docs(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            rows = out.count()
            assert rows <= docs.count() and (name == "encoding" or out.columns == docs.columns)
            if name in ("secrets", "encoding"):
                assert rows == docs.count()


def test_the_whole_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() < 200 and out.where("not decodes").count() == 0
