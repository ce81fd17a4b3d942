"""Exact duplicates, source divergence and periodic runs."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.llm import divergence, exact_dedup, queries, word_runs

BLANK = re.compile(r"[\x20\x09-\x0D]")


# --- exact duplicates --------------------------------------------------------------------


def sameness(rows):
    """Per row (doc_id, keep_id, group_size, sha256) by hand."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[BLANK.sub("", text or "")].append((-len(text or ""), i is None, i or 0, i))
    out = []
    for i, text in rows:
        norm = BLANK.sub("", text or "")
        out.append((i, min(groups[norm])[3], len(groups[norm]), hashlib.sha256(norm.encode()).hexdigest()))
    return Counter(out)


def copies(seed=1):
    draw = random.Random(seed)
    texts = ["", " \t\r\n\x0b\x0c", None, "a b", "ab", "a  b", " ab", "ab ", "AB", "é🙂", " é 🙂", "x" * 300_000, "x " * 300_000]
    rows = [(i, draw.choice(texts)) for i in range(60)] + [(None, "ab"), (None, "ab"), (7, "ab"), (7, "ab"), (None, "lone")]
    draw.shuffle(rows)
    return rows


def weak(text):
    """A content hash that takes texts of one length for the same."""
    return F.unhex(F.md5(F.char_length(text).cast("string")))


@pytest.mark.parametrize("digest", [exact_dedup.md5_128, weak])
@pytest.mark.parametrize("most", [100_000, 0])
def test_classes_by_hand(spark, monkeypatch, digest, most):
    monkeypatch.setattr(exact_dedup, "BROADCAST_GROUPS", most)
    rows = copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = exact_dedup.exact_classes(docs, digest=digest).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == sameness(rows)
    stays = [r for r in got if r.kept]
    assert all(r.doc_id == r.keep_id for r in stays)
    assert Counter(r.text_sha256 for r in stays) == Counter({r.text_sha256: 1 for r in got})


def test_hash_collisions_are_found(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, "cd"), (3, "a b"), (4, "xyz"), (5, "xyz")], "doc_id long, text string")
    copied = docs.select(weak(exact_dedup.normalised(F.col("text"))).alias("key")).distinct()
    assert exact_dedup.several_texts(docs, copied, digest=weak).count() == 1
    assert exact_dedup.several_texts(docs, copied.limit(0)).count() == 0


@pytest.mark.parametrize("digest", [exact_dedup.md5_128, weak])
def test_dedup_keeps_whole_rows(spark, digest):
    ddl = "doc_id long, text string, row string, key int, variant int, norm int, id int, place int, rank int, size int"
    rows = [(i, t, f"r{n}", *[n] * 7) for n, (i, t) in enumerate(copies(2))]
    docs = spark.createDataFrame(rows, ddl)
    kept = exact_dedup.exact_dedup(docs, digest=digest)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert {tuple(r) for r in found} <= set(rows)
    stays = Counter((keep, sha) for _, keep, _, sha in sameness([r[:2] for r in rows]))
    own = Counter((r.doc_id, hashlib.sha256(BLANK.sub("", r.text or "").encode()).hexdigest()) for r in found)
    assert own == Counter(dict.fromkeys(stays, 1))


def test_no_documents_no_classes(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, key int")
    assert exact_dedup.exact_classes(docs).count() == exact_dedup.exact_dedup(docs).count() == 0


# --- divergence of sources -----------------------------------------------------------------


def diverging(rows, least=10, ranks=10):
    """The contract's rows by hand."""
    rows = [tuple(x or "" for x in r) for r in rows]
    groups, documents, count = defaultdict(set), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        groups[lang].add(source)
        terms = [t.translate({c: c + 32 for c in range(65, 91)}) for t in re.findall(r"[A-Za-z\u0080-\U0010ffff]+", text)]
        documents[lang].update(set(terms))
        count[lang, source].update(terms)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in documents[lang].items() if n >= least]
        v = len(kept)

        def shares(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * v) for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        gap = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            pairs = [(o, sum(gap(p[s][t], p[o][t]) for t in kept)) for o in sources - {s}]
            terms = [(t, gap(p[s][t], q[t])) for t in kept if count[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)}
    return out


def prose(seed, documents, terms=40):
    draw = random.Random(seed)
    words = [f"{a}{b}" for a in "qwertzuiop" for b in "äsdf"][:terms] + ["é", "É", "日本", "x1y", "don't", "Z\u0085z", "🙂"]
    rows = []
    for _ in range(documents):
        said = draw.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=draw.randint(0, 60))
        said = [w.upper() if w.isascii() and draw.random() < 0.2 else w for w in said]
        rows.append((draw.choice(["en", "en", "de", None, ""]), draw.choice(["s1", "s2", "ä", "s3", None]), draw.choice([" ", "\x00", "7"]).join(said)))
    return rows


DOCS = "lang string, source string, text string"


@pytest.mark.parametrize("nodes,most", [(1_000_000, 100_000), (7, 0)])
def test_divergence_by_hand(spark, monkeypatch, nodes, most):
    monkeypatch.setattr(divergence, "MOST_NODES", nodes)
    monkeypatch.setattr(divergence, "BROADCAST_GROUPS", most)
    monkeypatch.setattr(divergence, "MOST_ENTRIES", nodes)
    rows = prose(5, 200) + [("en", "bare", None), ("xx", "a", "one"), ("xx", "b", None), ("yy", "only", "word"), (None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = divergence.source_divergence(docs)
    assert got.dtypes[-2:] == [("value", "bigint"), ("rank", "int")]
    found = [tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(found) == len(set(found)) and set(found) == diverging(rows)


def test_divergence_with_ties_and_other_columns(spark):
    rows = [("en", s, "b a c") for s in ("s1", "s2") for _ in range(10)] + [("en", "s3", "z " * 30_000)] * 10
    ddl = DOCS + ", term int, count int, docs int, place int, p int, base int"
    docs = spark.createDataFrame([(*r, *[1] * 6) for r in rows], ddl)
    got = {tuple(r) for r in divergence.source_divergence(docs).select("lang", "source", "part", "item", "value", "rank").collect()}
    assert got == diverging(rows)
    assert divergence.source_divergence(docs.limit(0)).count() == 0


def test_shares_do_not_overflow(spark):
    wide = spark.createDataFrame([(9_000_000_000_000_000, 9_100_000_000_000_000, 10**9)], "c long, n long, v long")
    assert wide.select(divergence.share("c", "n", "v")).first()[0] == 1 + 10**9 * (9 * 10**15 + 2) // (91 * 10**14 + 2 * 10**9)


def test_tree_shares_paths():
    tree = divergence.PatternTree()
    draw = random.Random(4)
    rows = [[(s, draw.choice([30, 50]), 20 + s) for s in range(1, 6) if draw.random() < 0.8] for _ in range(200)]
    for r in rows:
        tree.insert(r, 3)
    assert len(tree.many) < 1 + 3**5
    gap = lambda a, b: (a - b) ** 2 // (a + b)
    sums = Counter()
    for r in rows:
        for i, (b, pb, zb) in enumerate(r):
            for a, pa, za in r[:i]:
                sums[a, b] += 3 * (gap(pa, pb) - gap(pa, zb) - gap(za, pb) + gap(za, zb))
    assert tree.corrections() == sums
    assert divergence.PatternTree().corrections() == {}


# --- periodic runs -------------------------------------------------------------------------


def periodic(w, least_length=6, least_exponent=4):
    """All runs by comparing words at every distance."""
    n, out = len(w), []
    for q in range(1, n // least_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least_length, least_exponent * q):
                part = w[i : i + length]
                if all(any(x != y for x, y in zip(part, part[p:], strict=False)) for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 12), st.integers(0, 30), st.sampled_from([(6, 4), (2, 2), (9, 3), (30, 5)]))
def test_runs_by_brute_force(words, period, start, least):
    turned = [words[start + (i - start) % period] if i >= start and start + period <= len(words) else w for i, w in enumerate(words)]
    for w in (words, turned):
        assert word_runs.runs(w, *least) == periodic(w, *least)
        [(found, _)] = word_runs.text_runs([b" ".join(b"w%d" % x for x in w)], *least)
        assert found == periodic(w, *least)


def test_texts_of_a_chunk_do_not_mix():
    draw = random.Random(3)
    texts = [[draw.randint(0, 1) for _ in range(draw.choice([0, 1, 3, 30]))] for _ in range(300)]
    for least in ((6, 4), (2, 2), (8, 3)):
        got = word_runs.text_runs([b"\t".join(b"%d" % x for x in w) for w in texts], *least)
        assert [f for f, _ in got] == [periodic(w, *least) for w in texts]


def told(doc_id, text):
    """The contract's row by hand."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    found = periodic(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        digest("".join(f"{s},{length},{q}\n" for s, length, q in found)),
        digest(" ".join(w for i, w in enumerate(words) if i not in drop)),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_query_by_brute_force(spark, folder):
    draw = random.Random(8)
    rows = []
    for i in range(400):
        words = draw.choices(["a", "b", "A", "é ü", "🙂", "c,"], k=draw.randint(0, 90))
        rows.append((i, draw.choice([" ", "\t", " \n ", "\x0b"]).join(words)))
    rows += [(None, "x " * 9), (None, None), (3, ""), (5, None), (9, "z y " * 5), (9, "z y " * 5), (1001, "k l m " * 20_000)]
    rows += [(2000, " ".join(["a"] * 6 + ["b"] * 6 + ["c", "d"] * 3))]  # ties in exponent
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    got = queries.op13_periodic_runs(spark, folder).select(*COLUMNS)
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    long_one = [r for r in got.collect() if r.doc_id == 1001]
    assert [tuple(r)[1:5] for r in long_one] == [(1, 0, 60_000, 3)]
    assert Counter(tuple(r) for r in got.where("doc_id is null or doc_id <> 1001").collect()) == Counter(
        told(i, t) for i, t in rows if i != 1001
    )


def test_runs_keep_other_columns(spark):
    docs = spark.createDataFrame([("a b " * 6 + "c", 1, 2, "x")], "text string, runs int, collapsed int, best string")
    got = word_runs.collapse_runs(docs)
    assert got.columns == ["text", "best", "runs", "collapsed"]
    row = got.first()
    assert (row.collapsed, [tuple(r) for r in row.runs]) == ("a b c", [(0, 12, 2)])
    assert got.limit(0).count() == 0 and word_runs.collapse_runs(docs.limit(0)).count() == 0
