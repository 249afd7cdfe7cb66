import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import CLASHES, LONG, TEXTS, odd_docs
from pyspark.sql import functions as F

from weekmart.llm import lexical, periodic, personal, queries

SF = "/root/testdata/sf0.001"


# --- ranked lexical search -------------------------------------------------------------------------

def plain_terms(text):
    low = (text or "").translate(str.maketrans(lexical.UPPER, lexical.LOWER))
    return re.findall(lexical.TERM, low)


def plain_ranking(docs, items, k):
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for (i, c), size in zip(counted, sizes):
            if i is None or not size:
                continue
            m = 75 + 25 * size * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                for t in plain_terms(text) if t in c)
            if score > 0:
                scored.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def searched(spark, docs, items, k):
    found = lexical.ranked_search(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k)
    return sorted(tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("rows, seeds, pairs", [(1024, 2, 500_000), (7, 1, 500_000), (16, 1, 40)])
def test_ranking_equals_plain_scores(spark, monkeypatch, rows, seeds, pairs):
    for name, value in (("BUCKET_ROWS", rows), ("SEED_BUCKETS", seeds), ("BLOCK_PAIRS", pairs)):
        monkeypatch.setattr(lexical, name, value)
    rng = random.Random(rows)
    words = [f"w{k}" for k in range(60)] + ["Über", "日本", "naïve", "A1"]
    weights = [1 / (k + 1) for k in range(len(words))]
    docs = [(k, " ".join(rng.choices(words, weights, k=rng.choice([1, 5, 30, 200])))) for k in range(150)]
    docs += [(200 + k, docs[3][1]) for k in range(30)] + [(7, "w3 w9"), (None, "w1 w2"), (500, None), (501, "--- !"), (502, "")]
    items = [(k, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for k in range(12)] + [(90, None), (91, "nowhere"), (92, "")]
    assert searched(spark, docs, items, 5) == sorted(plain_ranking(docs, items, 5))


def test_buckets_pass_over_what_cannot_reach_the_threshold():
    rng = np.random.default_rng(3)
    terms = np.sort(rng.choice(40, 6, replace=False)).astype(np.int32)
    values = rng.integers(1, 10**6, 6)
    bucket = lexical.Bucket(np.arange(2), np.array([4, 2]), terms, values)
    weights = np.array([900, 40, 3])
    query = lexical.Query(terms[[0, 4, 5]].astype(np.int64), weights, math.sqrt(float((weights**2).sum())))
    weight_of = np.zeros(40, np.int64)
    weight_of[query.terms] = weights
    exact = bucket.scores(np.arange(2), weight_of)
    for floor in (1, int(exact.min()), int(exact.max()), int(exact.max()) + 1):
        kept = set(bucket.survivors(query, floor).tolist())
        assert {k for k in range(2) if exact[k] >= floor} <= kept
    assert not len(bucket.survivors(query, int(query.length * bucket.longest) + 10))


def test_terms_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(lexical, "span_hashes", lambda data, a, b: np.zeros(len(a), np.uint64))
    known = lexical.vocabulary(["ab", "cd"])
    data = np.frombuffer(b"cd ab xy", np.uint8)
    number = lexical._listed(known, data, np.array([0, 3, 6]), np.array([2, 5, 8]))
    names = [known.data[a:b].tobytes() for a, b in zip(known.starts, known.ends)]
    assert [names[n] if n >= 0 else None for n in number] == [b"cd", b"ab", None]


def test_impacts_of_enormous_corpora_do_not_overflow():
    assert lexical.impacts(np.array([1]), np.array([10**8]), 10**12, 10**15).tolist() == [10**9 // (1000 + 12 * (75 + 25 * 10**5))]


def test_ranking_of_odd_documents_and_empty_tables(spark):
    docs = odd_docs(spark)
    items = spark.createDataFrame([(1, "eight word", "x"), (None, "ende", "x"), (1, "three one", "x"), (2, None, "x")], "item_id int, text string, score string")
    found = [tuple(r) for r in lexical.ranked_search(docs, items, 3).collect()]
    listed = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(found, key=str) == sorted(plain_ranking(listed, [(1, "eight word"), (None, "ende")], 3), key=str)
    assert lexical.ranked_search(docs.limit(0), items).count() == 0
    assert lexical.ranked_search(docs, items.limit(0)).count() == 0
    assert lexical.ranked_search(docs.where("text = ''"), items).count() == 0


# --- personal data -----------------------------------------------------------------------------------

PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(number):
    return sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(map(int, reversed(number)))) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PLAIN:
        for m in re.finditer(pattern, text):
            number = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split("."))) or (kind == "phone" and not 8 <= len(number) <= 15) or (
                    kind == "card" and not (16 <= len(number) <= 19 and luhn(number))):
                continue
            out.append((kind, *m.span()))
    return out


def spans_of(spark, texts):
    rows = personal.with_spans(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")).orderBy("doc_id").collect()
    return [[(s.kind, s.start, s.end) for s in r.spans] for r in rows]


def test_base_spans_equal_the_plain_patterns(spark):
    rng = random.Random(8)
    parts = ["a@b.c", "@", ".", "..", "x_y", "%", "1", "12", "255", "256", "007", " ", "-", "+", "+49 (30) 555-0199", "(", ")", "4539 1488 0343 6467",
             "4539148803436467", "0000", "日本", "😀", "\n", "é", "joe.bloggs+x@mail-1.example.co.uk", "1.2.3.4", "10.0.0.1", "b", "--", "  "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(600)]
    for text, spans in zip(texts, spans_of(spark, texts)):
        assert [s for s in spans if s[0] in personal.BASE] == plain_base(text), text


def test_many_matches_in_one_text_keep_their_places(spark):
    text = "é " + " ".join(f"u{k}@h{k}.org 10.0.{k % 256}.{k % 300}" for k in range(3 * personal.BLOCK + 5))
    assert [s for s in spans_of(spark, [text])[0]] == plain_base(text)


def test_long_runs_are_read_once(spark):
    texts = ["a" * 2_000_000, "7" * 2_000_000, "1." * 500_000, "a@" + "b." * 500_000, "+1" + "(" * 1_000_000, "1 " * 500_000, "A1" * 500_000, "+1-" * 300_000]
    found = spans_of(spark, texts)
    assert found[3] == [("email", 0, 2 + 999_999)]
    assert [len(f) for k, f in enumerate(found) if k not in (2, 3)] == [0] * 6
    assert len(found[2]) == 125_000


@pytest.mark.parametrize("text, kinds", [
    ("IBAN DE89 3704 0044 0532 0130 00 please", ["iban"]), ("GB82WEST12345698765432", ["iban"]), ("DE89 3704 0044 0532 0130 01", []),
    ("xDE89370400440532013000", []), ("FR1420041010050500013M02606", ["iban"]), ("my amex card: 378282246310005", ["account"]), ("number 378282246310005", []),
    ("SSN: 078-05-1120", ["ssn"]), ("order 078-05-1120", []), ("SSN 000-05-1120", []), ("social security 1078-05-1120", []), ("ssn 078-05-1120-7", [])])
def test_checks_and_words_decide_the_added_kinds(spark, text, kinds):
    assert [s[0] for s in spans_of(spark, [text])[0]] == kinds


def test_words_nearby_change_the_score(spark):
    texts = ["ip 10.0.0.1", "10.0.0.1", "version 10.0.0.1", "Card 4539 1488 0343 6467", "x" * 60 + " 4539 1488 0343 6467", "discard 4539 1488 0343 6467"]
    rows = personal.with_spans(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert [r.spans[0].score for r in rows] == [80, 50, 20, 90, 60, 60]


def test_personal_data_in_odd_documents(spark):
    docs = odd_docs(spark, [*TEXTS, "mail a@b.co", "+49 30 5550199"])
    found = personal.with_spans(docs)
    assert found.columns == docs.columns and found.count() == docs.count()
    told = {(r.doc_id, r.text): [tuple(s)[:3] for s in r.spans] for r in found.collect()}
    assert all([s for s in spans if s[0] in personal.BASE] == plain_base(text or "") for (_, text), spans in told.items())
    assert personal.with_spans(docs.limit(0)).count() == 0
    clashing = docs.select("doc_id", "text", *[F.lit("x").alias(c) for c in ("hits", "Gaps", "_ends", "found")])
    assert personal.with_spans(clashing).columns == [*clashing.columns, "spans"]
    assert {r.Gaps for r in personal.with_spans(clashing, spans="found").collect()} == {"x"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


# --- periodic runs -----------------------------------------------------------------------------------

def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, q, n) for (s, n), q in found.items())


def found_runs(texts):
    rows = periodic.find_runs(np.array([w for t in texts for w in t], np.int64), np.array([len(t) for t in texts], np.int64))
    out = [[] for _ in texts]
    for t, (s, n, q) in zip(rows[0].tolist(), rows[1].tolist()):
        out[t].append((s, q, n))
    return out


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    w = [0]
    while len(w) < n:
        w = w + [1 - x for x in w]
    return w[:n]


def test_runs_of_well_known_words():
    texts = [fibonacci(1500), thue_morse(1500), [0] * 200, [0, 1] * 90, list(range(100)) * 3, list(range(100)) * 2 + list(range(99)),
             list(range(8)) * 3, list(range(8)) * 2 + list(range(7)), ([0] * 40 + [1]) * 5, ([0, 1, 2, 1] * 30 + [0, 1]) * 4, [5], []]
    assert found_runs(texts) == [plain_runs(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=70), st.integers(1, 9)), max_size=5), min_size=1, max_size=4))
def test_runs_equal_a_search_of_all_periods(shapes):
    texts = [[w for unit, times in shape for w in (unit * times)[:400]] for shape in shapes]
    assert found_runs(texts) == [plain_runs(t) for t in texts]


def test_equal_hashes_change_no_run(monkeypatch):
    texts = [fibonacci(400), list(range(40)) * 4, [0, 1, 1, 0, 2] * 30]
    monkeypatch.setattr(periodic, "_mixed", lambda values: values % np.uint64(5))
    assert found_runs(texts) == [plain_runs(t) for t in texts]


def test_long_texts_are_searched_in_proportion_to_their_words():
    for words in ([0] * 400_000, list(range(100_000)) * 4, ([0] * 9 + [1]) * 40_000):
        [[(start, period, length)]] = found_runs([words])
        assert (start, length) == (0, len(words)) and period in (1, 10, 100_000)


def plain_digest(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = plain_runs(words)
    dropped = {k for s, q, n in runs for k in range(s + q, s + n)}
    return runs, " ".join(w for k, w in enumerate(words) if k not in dropped)


def test_runs_of_odd_documents(spark):
    texts = [*TEXTS, "a b  c\n" * 12 + "end", "x " * 30 + "é\u0085 " * 25, "😀 日本\t" * 40]
    docs = odd_docs(spark, texts)
    found = periodic.with_runs(docs)
    assert found.columns == [*docs.columns, "periodic"] and found.count() == docs.count()
    for r in found.collect():
        if r.text != LONG:
            assert ([(x.start, x.period, x.length) for x in r.periodic.runs], r.periodic.collapsed) == plain_digest(r.text)
        else:
            assert [tuple(x) for x in r.periodic.runs] == [(0, 40_000, 1)] and r.periodic.collapsed == "word Ende " + "x" * 50_000
    assert periodic.with_runs(docs.limit(0)).count() == 0
    assert periodic.with_runs(docs, name=CLASHES[0]).count() == docs.count()


def test_pieces_of_a_batch_do_not_matter(monkeypatch):
    texts = pa.array(["a b " * 20, None, "x y z " * 30 + "end", "", "one two"] * 3)
    whole = periodic._found(texts)
    monkeypatch.setattr(periodic, "pieces", lambda offsets: ((k, k + 1) for k in range(len(offsets) - 1)))
    assert periodic._found(texts).equals(whole)


def test_op13_equals_a_plain_reading_of_its_contract(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("length(text) < 6000").collect()
    texts = {r.doc_id: r.text for r in docs}
    rows = {r.doc_id: r for r in queries.op13_periodic_runs(spark, SF).collect()}
    assert len(rows) >= len(texts)
    planted = 0
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            planted += 1
        runs, collapsed = plain_digest(" ".join(words))
        best = min(runs, key=lambda r: (-r[2] / r[1], r[0], r[1]), default=None)
        r = rows[i]
        assert r.n_runs == len(runs) and (r.start, r.period, r.length) == (best or (None,) * 3)
        assert r.exponent_milli == (best and 1000 * best[2] // best[1])
        listed = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed.encode()).hexdigest()
    assert planted > 5


# --- SQL ---------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_personal_data"])
def test_queries_equal_their_sql_on_planted_rows(spark, tmp_path, name):
    extra = ["IBAN DE89 3704 0044 0532 0130 00, GB82WEST12345698765432.", "ssn 078-05-1120 and 1078-05-1120; amex 378282246310005", "ip 1.2.3.4.5.6.7.8 256.1.1.1",
             "a@b.c_x@y.z ..@d.e.f. +49 30 5550199", None, "", "Card 4539-1488-0343-6467 x 4539148803436467"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(extra)], "doc_id long, text string"))
    docs.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    base = duckdb.connect()
    for table in ("documents", "benchmark"):
        base.sql(f"CREATE VIEW {table} AS FROM '{tmp_path}/{table}.parquet/*.parquet'")
    told = base.sql(queries.SQL[name])
    found = queries.QUERIES[name](spark, str(tmp_path)).select(*told.columns)
    assert sorted(map(tuple, found.collect())) == sorted(told.fetchall())
    if name.startswith("op12"):
        assert found.where(F.col("spans").contains("iban") | F.col("spans").contains("ssn")).count() == 2
