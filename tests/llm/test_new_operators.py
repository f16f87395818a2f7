"""Toxic spans, phrase mining and tokenizer alignment against brute force and on hostile tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import alignment, chain_field, line_dedup, phrases, queries, toxicity
from tarmac.llm.chain_field import Layout
from tests.conftest import SF_SMALL
from tests.llm.test_operators import ROWS, SCHEMA

PATHS = (queries.BYTE_MODEL, queries.PIECE_MODEL)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# --- the chain -------------------------------------------------------------------------

def chain(sizes, seed=0):
    rng = np.random.default_rng(seed)
    layout = Layout(np.array(sizes))
    return layout, rng.normal(0, 3, sum(sizes)), rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2)


def plain_marginals(sizes, e, trans, start):
    out, pairs, at, log_z = [], np.zeros((2, 2)), 0, 0.0
    t = np.exp(trans)
    for n in sizes:
        x = np.stack([np.ones(n), np.exp(e[at:at + n])], 1)
        at += n
        if not n:
            continue
        a, b = np.zeros((n, 2)), np.ones((n, 2))
        a[0] = np.exp(start) * x[0]
        for k in range(1, n):
            log_z += np.log(a[k - 1].sum())
            a[k - 1] /= a[k - 1].sum()
            a[k] = (a[k - 1] @ t) * x[k]
        log_z += np.log(a[-1].sum())
        for k in range(n - 2, -1, -1):
            b[k] = t @ (x[k + 1] * b[k + 1])
            b[k] /= b[k].sum()
        g = a * b
        out.append(g[:, 1] / g.sum(1))
        for k in range(n - 1):
            y = a[k][:, None] * t * (x[k + 1] * b[k + 1])[None]
            pairs += y / y.sum()
    return np.concatenate(out), pairs, log_z


def test_marginals_equal_the_plain_recursion():
    sizes = [0, 1, 5, 200, 64, 65, 128, 2]
    layout, e, trans, start = chain(sizes)
    for w in (trans, np.zeros((2, 2))):
        p, pairs = chain_field.marginals(e, layout, w, start)
        want, want_pairs, _ = plain_marginals(sizes, e, w, start)
        assert np.allclose(p, want, atol=1e-12) and np.allclose(pairs, want_pairs, atol=1e-9)


def test_gradient_is_the_slope_of_the_likelihood():
    words = ["bad", "worse", "fine", "good", "badly"]
    table, rng = chain_field.feature_table(words), np.random.default_rng(3)
    sizes = [7, 1, 70]
    layout, ids = Layout(np.array(sizes)), rng.integers(0, 5, 78)
    tags = rng.integers(0, 2, 78).astype(float)
    field = chain_field.Field(rng.normal(0, .3, 1 << chain_field.TABLE_BITS), rng.normal(0, .5, (2, 2)),
                              rng.normal(0, .5, 2))
    field.weights[0] = 0

    def likelihood():
        e = chain_field.emissions(ids, field.of_words(table), layout)
        y, total = tags.astype(int), float((e * tags).sum())
        total += sum(field.trans[y[k], y[k + 1]] for k in range(77) if layout.doc[k] == layout.doc[k + 1])
        total += sum(field.start[y[f]] for f in layout.first)
        return total - plain_marginals(sizes, e, field.trans, field.start)[2]

    gradient = chain_field.gradient(field, ids, table, layout, tags)
    for x, g, places in ((field.weights, gradient[0], [(i,) for i in np.unique(table[:2])[1:6]]),
                         (field.trans, gradient[1], [(0, 1), (1, 1)]), (field.start, gradient[2], [(0,), (1,)])):
        for at in places:
            x[at] += 1e-5
            up = likelihood()
            x[at] -= 2e-5
            down = likelihood()
            x[at] += 1e-5
            assert abs((up - down) / 2e-5 - g[at]) < 1e-4


def toxic_docs(spark, n=600):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    rows, labels = [], []
    for i in range(n):
        w, toxic = [word() for _ in range(rng.randint(0, 60))], int(rng.random() < .25)
        for _ in range(3 * toxic):
            w.insert(rng.randint(0, len(w)), rng.choice(["Zwirn", "zwirnen", "quoxel"]))
        rows.append((i, " ".join(w)))
        labels.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(
        labels + [(n + 5, 1), (3, None), (None, 1)], "doc_id long, toxic int"), dict(labels)


def test_toxic_spans_on_held_out_documents(spark):
    docs, labels, truth = toxic_docs(spark)
    rows = toxicity.tag_documents(docs, labels).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in texts if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= .97 * len(held)
    spans = []
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= .5)
        assert all(s.probability >= .5 for s in r.spans)
        spans += [texts[r.doc_id][s.start:s.end].lower().split() for s in r.spans]
    named = [any(w in ("zwirn", "zwirnen", "quoxel") for w in found) for found in spans]
    assert len(named) > 200 and sum(named) >= .95 * len(named)


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels, _ = toxic_docs(spark, 200)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic"))
                               .otherwise(F.col("toxic")))
    score = lambda x: sorted((r.doc_id, r.score) for r in toxicity.tag_documents(docs, x).collect())
    assert score(labels) == score(turned)


def test_toxicity_defined_cases(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 3 == 0) for i in range(60)], "doc_id long, t boolean").select(
        "doc_id", F.col("t").cast("int").alias("toxic"))
    rows = toxicity.tag_documents(docs, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in ROWS)
    blank = [r for r in rows if r.doc_id in {x[0] for x in ROWS if not (x[1] or "").strip()}]
    assert len({r.score for r in blank}) == 1 and all(r.spans == [] for r in blank)
    assert toxicity.tag_documents(none, labels).collect() == []
    assert {r.score for r in toxicity.tag_documents(docs, labels.filter("toxic = 0")).collect()} == {0.0}


# --- phrases ---------------------------------------------------------------------------

def brute_phrases(rows, least, longest=4):
    counts = Counter()
    for lang, text in rows:
        raw = (text or "").encode().lower()
        for c in phrases.ENDS:
            raw = raw.replace(bytes([c]), b"\n")
        for piece in raw.split(b"\n"):
            w = [x.decode() for x in piece.replace(b"\t", b" ").split(b" ") if x]
            for k in range(1, longest + 1):
                counts.update((lang or "und", " ".join(w[i:i + k])) for i in range(len(w) - k + 1))
    return {p: n for p, n in counts.items() if n >= least}


@pytest.mark.parametrize("share", [0.02, 0.5, 1.0])
def test_frequent_phrases_equal_brute_force(docs, share):
    """Whatever the sample misses, the expansion passes find."""
    found, totals = phrases.frequent_phrases(docs, least=20, share=share)
    got = [((r.lang, r.phrase), r.n) for r in found.collect()]
    want = brute_phrases([(r[2], r[1]) for r in ROWS], 20)
    assert len(got) == len(dict(got)) and dict(got) == want
    words = Counter()
    for (lang, p), n in brute_phrases([(r[2], r[1]) for r in ROWS], 1, 1).items():
        words[lang] += n
    assert {r.lang: r.n for r in totals.collect()} == words


def test_an_expansion_counts_all_that_a_crowded_filter_left_out():
    """False positives of the filter: what the first pass did not count, the second one does."""
    rng = np.random.default_rng(3)
    text = " ".join(f"w{i}" for i in range(3000))
    crowded = phrases.Filter(rng.integers(0, 256, phrases.FILTER_BITS // 8, np.uint8)
                             | rng.integers(0, 256, phrases.FILTER_BITS // 8, np.uint8))
    full = phrases.Filter(np.full(phrases.FILTER_BITS // 8, 255, np.uint8))
    told = lambda *a: [p for found, _, _ in phrases.count_phrases([text], "en", *a) for p in found]
    first = told(range(1, 5), crowded, None, False)
    second = told(range(2, 5), full, crowded, False)
    w = text.split()
    want = {" ".join(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1)}
    assert set(first) | set(second) == want and not set(first) & set(second)


def test_collocations_by_their_definition(docs, none):
    f = brute_phrases([(r[2], r[1]) for r in ROWS], 20)
    best = defaultdict(list)
    for (lang, p), a in f.items():
        w = p.split(" ")
        around = max((n for (x, q), n in f.items() if x == lang and len(q.split(" ")) > len(w)
                      and f" {p} " in f" {q} "), default=0)
        if len(w) > 1 and 100 * around < 80 * a:
            cuts = [(f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]) for k in range(1, len(w))]
            score, _, l, r = min((2000000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
            best[lang].append((-score, -a, p.encode(), l, r))
    want = [(lang, k, p.decode(), -a, l, r, -s) for lang, x in best.items()
            for k, (s, a, p, l, r) in enumerate(sorted(x)[:25], 1)]
    got = [(r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.score)
           for r in phrases.collocations(docs, least=20, top=25).collect()]
    assert sorted(got) == sorted(want) and want
    assert phrases.collocations(none).collect() == []


# --- alignment -------------------------------------------------------------------------

ODD = ["  x  y ", "a▁b", "<s> </s> <|endoftext|>", "tab\tand\nnew  \n\n line ", "日本語 テキスト🙂 x", " ", "\x00\x01 z"]


def brute_alignment(texts):
    a, b = map(alignment.Side, alignment.tokenizers(*PATHS))
    groups, links = [], []  # A's tokens are compared with the library's below
    for t in texts:
        ids_a, ids_b = a.encode(t or ""), b.encode(t or "")
        whole = (" " + (t or "")).encode()
        if not t or b"".join(a.bytes[i] for i in ids_a) != whole or b"".join(b.bytes[i] for i in ids_b) != whole:
            groups.append("")
            links.append([])
            continue
        ends = [np.cumsum([len(s.bytes[i]) for i in ids]).tolist() for s, ids in ((a, ids_a), (b, ids_b))]
        out, own, i, j = [], [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(e) + 1, ends[1].index(e) + 1
            out.append(",".join(map(str, ids_a[i:x])) + "|" + ",".join(map(str, ids_b[j:y])))
            own.append((ids_a[x - 1], ids_b[y - 1]))
            i, j = x, y
        groups.append(";".join(out))
        links.append(own)
    return groups, links


def test_alignment_equals_brute_force(spark):
    texts = [r[1] for r in ROWS if len(r[1] or "") < 20000] + ODD
    docs = spark.createDataFrame([(f"id{i % 50}", t) for i, t in enumerate(texts)],
                                 "name string, text string").repartition(4)
    got = sorted(tuple(r) for r in alignment.align_documents(docs, *PATHS, key="name").collect())
    groups, links = brute_alignment(texts)
    counts = Counter(x for own in links for x in own)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    want = []
    for i, (g, own) in enumerate(zip(groups, links)):
        sides = [[x for x in ",".join(p.split("|")[k] for p in g.split(";")).split(",")] if g else [] for k in (0, 1)]
        want.append((f"id{i % 50}", len(sides[0]), len(sides[1]), len(own), len(own),
                     sum(counts[x] == most[x[1]] for x in own), sum(counts[x] for x in own), g))
    assert got == sorted(want)


def test_tokens_are_those_of_the_file(spark):
    """The merges in the file's ranks against the library that the file is for."""
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(PATHS[0])
    plain.encode_special_tokens = True
    a, rng = alignment.TokenizerA(PATHS[0]), random.Random(11)
    bits = ["ab", "Don't", "12", "3.5", " ", "  ", "\t", "\n", "\r\n", "\u00a0", "\u200b", "\u180e", "\x1c", "\x85", "!?",
            "\u3000", "é", "日本", "🙂", "'s", "\x00", "<|endoftext|>", "\u2028", "ſ", "²", "\u0301"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    texts += [r[1] or "" for r in ROWS]
    for t in texts:
        assert a.encode(t) == plain.encode(" " + t, add_special_tokens=False).ids, t


def test_alignment_query_and_arrays(spark, docs, none):
    rows = queries.op13_tokenizer_alignment(spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    groups, _ = brute_alignment([texts[r.doc_id] for r in rows])
    assert [r.groups_sha256 for r in rows] == [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
    assert alignment.align_documents(none, *PATHS).collect() == []
    one = spark.createDataFrame([("7,8|9;1|2,3",), ("",)], "g string").select(
        alignment.group_arrays(F.col("g")).alias("x")).collect()
    assert [[(p.a, p.b) for p in r.x] for r in one] == [[([7, 8], [9]), ([1], [2, 3])], []]


# --- line dedup keeps what occurs once -------------------------------------------------

def test_rows_that_share_an_identifier_keep_their_own_lines(spark):
    rows = [(None, "first text line here\nshared line of words", "p"),
            (None, "shared line of words\nanother thing only here", "q"),
            (7, "alpha beta gamma delta\nshared line of words", "r"), (7, "unique at the second row", "s"),
            (9, None, "t"), (9, "", "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _lost_id string")
    got = Counter((r.doc_id, r.text, r._lost_id) for r in line_dedup.drop_repeated_lines(df).collect())
    texts = {r[2]: r[1] for r in got}
    assert {r[2]: r[0] for r in got} == {r[2]: r[0] for r in rows} and sum(got.values()) == len(rows)
    lines = Counter(x for t in texts.values() for x in (t or "").split("\n") if x)
    assert lines == Counter({x: 1 for r in rows for x in (r[1] or "").split("\n") if x})
    assert texts["r"] == "alpha beta gamma delta" and texts["t"] is None and texts["u"] == ""
    named = spark.createDataFrame([("b", "x y z w"), ("a", "x y z w")], "doc_id string, text string")
    assert {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(named).collect()} == {"a": "x y z w", "b": ""}


def test_windows_are_told_apart_whatever_their_hashes(monkeypatch):
    """With hashes that collide at first, numbers come from a later seed."""
    a, b = map(alignment.Side, alignment.tokenizers(*PATHS))
    texts = ["one two three", "two one", "", None, "three  two\none", "one two three"]
    each = [alignment.tokens_of(a, b, t) for t in texts]
    ids = tuple(np.concatenate(x) for x in zip(*each))
    plain, asked, mix = alignment.Windows(a, b, ids), [], alignment.mix

    def weak(x):
        asked.append(1)
        return x * np.uint64(0) if len(asked) <= 4 else mix(x)

    monkeypatch.setattr(alignment, "mix", weak)
    again = alignment.Windows(a, b, ids)
    same = lambda w: [[i == j for j in w.numbers] for i in w.numbers]
    assert len(asked) > 4 and same(again) == same(plain) and len(plain.kept) < len(plain.numbers)
