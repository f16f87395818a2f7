"""Each operator against brute force, on a table with nulls, empty and long texts, ties and repeats."""

import hashlib
import math
import random
import re
import struct
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tarmac.llm import (chat, exact_dedup, jaccard_join, line_dedup, lm_scoring, mixing, pii, quality,
                        queries, recurrent, sentencepieces, sharding)
from tarmac.llm.common import CLEANUP, materialise
from tarmac.llm.components import connected_components
from tarmac.llm.queries import PIECE_MODEL
from tarmac.llm.signature_tree import SignatureTree, signature

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, norm string, _copies long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def make_docs():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6)))
    rows, texts = [], []
    for i in range(120):
        lines = [" ".join(word() for _ in range(rng.randint(3, 25))) for _ in range(rng.randint(1, 5))]
        texts.append("\n".join(lines))
    texts += [texts[0]] * 30 + [texts[1].replace(" ", "  \t")] * 3 + [texts[2].upper()]
    texts += ["", None, "   ", "one", "two words", "word " * 30, "x" * 5000, "long text " * 20000]
    for t in texts[3:13]:  # near copies
        w = t.split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    for i, t in enumerate(texts):
        rows.append((i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None, "hot"]), 1, "x", 2))
    rows += [rows[5], rows[5], (None, "null id " + texts[4], "en", "a", 0, None, None)]
    rng.shuffle(rows)
    return rows


ROWS = make_docs()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def test_exact_dedup(docs, none):
    got = exact_dedup.dedup_groups(docs).collect()
    groups = defaultdict(list)
    for r in ROWS:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    least = lambda ids: min(ids, key=lambda x: (x is not None, x or 0))
    want = sorted(((i, least(ids), len(ids), hashlib.sha256(t.encode()).hexdigest())
                   for t, ids in groups.items() for i in ids), key=repr)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    assert sum(r.kept for r in got) == len(groups)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=repr) == sorted(map(least, groups.values()), key=repr)
    assert exact_dedup.dedup_groups(none).count() == exact_dedup.keep_first(none).count() == 0


def test_lm_scoring_base_and_probabilities(docs, none):
    got = {(r.doc_id, r.n_tokens): r for r in lm_scoring.score_documents(docs).collect()}
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    tokens = [(r[0], words_of(r[1]) + [" "]) for r in ROWS]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens:
        r = got[i, len(ws)]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert (r.held_out, r.n_known, r.train_tokens) == (held(i), sum(c[w] > 0 for w in ws), n)
        assert math.isfinite(r.score) and r.score < 0
    assert lm_scoring.score_documents(none).count() == 0


def test_recurrent_model_is_a_distribution_and_learns():
    shape = recurrent.Shape(7, (0, 3, 4), 5)
    p = recurrent.initial(shape, np.arange(7.0))
    p["C"] += 0.3
    p["W"] += np.random.default_rng(1).normal(size=p["W"].shape).astype(np.float32)
    h = np.random.default_rng(0).normal(size=(1, 5)).astype(np.float32)
    total = sum(math.exp(recurrent.log_probabilities(p, shape, h, np.array([y]))[0]) for y in range(7))
    assert abs(total - 1) < 1e-5
    # states in windows equal states step by step, across many windows
    x = np.random.default_rng(2).integers(0, 7, 200)
    x[0] = 0
    state, steps = np.zeros(5), []
    for code in x:
        f = 0 if code == 0 else 1 / (1 + np.exp(-p["F"][code]))
        state = f * state + (1 - f) * np.tanh(p["Z"][code])
        steps.append(state)
    assert np.allclose(recurrent.states(p, x), steps, atol=1e-5)
    codes = np.tile([1, 2, 5, 3, 0], 4000)
    trainer = recurrent.Trainer(recurrent.initial(shape, np.ones(7)), shape, 0.05)
    before = recurrent.score_stream(trainer.p, shape, codes).mean()
    for _ in range(3):
        trainer.learn(codes)
    assert recurrent.score_stream(trainer.p, shape, codes).mean() > before / 3


def test_gradient_agrees_with_difference_quotients_and_padding_counts_for_nothing():
    rng = np.random.default_rng(5)
    shape = recurrent.Shape(7, (0, 3, 4), 5)
    p = {k: v.astype(float) + rng.normal(0, 0.3, v.shape) for k, v in recurrent.initial(shape, np.ones(7)).items()}
    x, y = rng.integers(0, 7, (2, 6, 3))
    live = np.ones((6, 3), bool)
    live[4:, 2] = False
    before = rng.normal(0, 0.5, (3, 5))

    def loss():
        h, state = [], before
        f, z = recurrent._gates(p, x)
        for t in range(6):
            state = f[t] * state + (1 - f[t]) * z[t]
            h.append(state)
        told = recurrent.log_probabilities(p, shape, np.concatenate(h), y.reshape(-1))
        return -told[live.reshape(-1)].mean()

    trainer, seen = recurrent.Trainer(p, shape, 0.05), {}
    trainer._update = seen.update
    trainer.window(x, y, before, live)
    for name, grad in seen.items():
        for at in np.ndindex(p[name].shape):
            if name == "F" and at[0] == 0:  # the gate of the end is fixed
                continue
            old, step = p[name][at], 1e-5
            p[name][at] = old + step
            up = loss()
            p[name][at] = old - step
            down, p[name][at] = loss(), old
            assert abs((up - down) / (2 * step) - grad[at]) < 1e-6, (name, at)


@pytest.mark.parametrize("n", [1, 3, 4, 5, 130, 8191, 8193, 8500])
def test_every_token_is_learnt(n):
    shape, told = recurrent.Shape(9, (0, 3, 4), 3), Counter()
    trainer = recurrent.Trainer(recurrent.initial(shape, np.ones(9)), shape, 0.05)
    window = trainer.window

    def watched(x, y, before, live):
        told.update(y[live].tolist())
        assert x[0, 0] is not None and live.shape == y.shape
        return window(x, y, before, live)

    trainer.window = watched
    codes = np.random.default_rng(n).integers(0, 9, n)
    trainer.learn(codes)
    assert told == Counter(codes.tolist())


BARE = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]+(?:(?:\.|[ ]dot[ ])[A-Za-z0-9_%+-]+)*"
                  r"(?:[ ]at[ ]|@)[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*"
                  r"(?:[ ]dot[ ][A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)+"
                  r"|\b[0-9]{1,3}(?:[ ]dot[ ][0-9]{1,3}){3}\b", re.I)


def test_bare_addresses_equal_one_pattern():
    rng = random.Random(11)
    parts = [" dot ", " at ", "@", ".", " ", "a", "b1", "7", "210", "dot", "at", "AT", " DOT ", "-", "_", "ſ", "é", "\n"]
    found = 0
    for _ in range(60_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 24)))
        want = [m.span() for m in BARE.finditer(text)]
        assert list(pii.bare_spans(text)) == want, text
        found += len(want)
    assert found > 1000


@pytest.mark.parametrize("part", ["a dot ", "a at ", "a@", "1 dot ", "a.", "a dot a@a dot ", "one two ", "a [at] ", "( at ",
                                  "+1 ", "1-", "1.", "a_at_", "a. dot "])
def test_hostile_texts_take_time_in_proportion(part):
    def took(n):
        text = part * (n // len(part)) + "x"
        start = time.process_time()
        pii.all_spans(text)
        return time.process_time() - start
    took(20_000)
    assert took(1_000_000) < 100 * took(50_000) + 2


def test_held_out_documents_score_above_base(spark):
    rng = random.Random(3)
    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(a if i % 2 else b) for _ in range(60))) for i in range(600)]
    got = lm_scoring.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out")
    base, score = got.selectExpr("sum(base_score)", "sum(score)").first()
    assert score > base + 100


def test_sentence_pieces_equal_the_library(spark, docs, none):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    odd = spark.createDataFrame(
        [(1, "  Hello  wörld\nnew\tx ▁ß 你好 <s> "), (2, "thethethe" * 60 + " é😀"), (3, "\n\n"), (4, "a\x00b")],
        "doc_id long, text string")
    for table in (docs, odd):
        texts = defaultdict(set)
        for r in table.select("doc_id", "text").collect():
            texts[r.doc_id].add(tuple(sp.encode(r.text or "")))
        coded = sentencepieces.encode_documents(table, PIECE_MODEL)
        for r in coded.collect():
            assert tuple(r.piece_ids) in texts[r.doc_id] and r.n_pieces == len(r.piece_ids) and r.round_trip
        back = {r.doc_id: r.text for r in sentencepieces.decode_documents(
            coded.filter("doc_id is not null").dropDuplicates(["doc_id"]), PIECE_MODEL).collect()}
        for r in table.filter("doc_id is not null").select("doc_id", "text").collect():
            assert back[r.doc_id] == (r.text or "").replace("▁", " ")
    assert sentencepieces.encode_documents(none, PIECE_MODEL).count() == 0


@pytest.mark.parametrize("work", [
    lambda docs: sentencepieces.encode_and_decode(docs, PIECE_MODEL), lambda docs: quality.judge_documents(
        docs, docs.sparkSession.createDataFrame([], "doc_id long, quality int"))])
def test_batches_of_texts_are_bounded(spark, none, work):
    """Whatever was set before: rows and bytes that a worker holds at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert work(none).count() == 0
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "2000"
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "8m"


def test_decoding_keeps_rows_apart(spark):
    texts = [(1, "one text"), (1, "one text"), (1, "another"), (None, "no identifier"), (None, "none\nat all é😀"),
             (2, ""), (2, None)]
    coded = sentencepieces.encode_documents(spark.createDataFrame(texts, "doc_id long, text string"), PIECE_MODEL)
    back = [(r.doc_id, r.text) for r in sentencepieces.decode_documents(coded, PIECE_MODEL).collect()]
    assert sorted(back, key=repr) == sorted(((k, t or "") for k, t in texts), key=repr)
    odd = spark.createDataFrame([(1, [1 << 30, -1, None]), (2, None)], "doc_id long, piece_ids array<int>")
    assert [r.text for r in sentencepieces.decode_documents(odd, PIECE_MODEL).collect()] == ["", ""]


def test_round_trip_is_told_by_decoding(spark, tmp_path, monkeypatch):
    texts = ["plain text", " led by a space", "a ▁ mark", "▁", "", None, "é😀\n\t", "▁" * 70]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(path)
    told = lambda: sorted((r.doc_id, r.round_trip) for r in queries.op3_sentence_pieces(spark, str(tmp_path)).collect())
    assert told() == sorted((i % 3, "▁" not in (t or "")) for i, t in enumerate(texts))
    # a fault of the decoder shows
    whole = sentencepieces.Model.written
    monkeypatch.setattr(sentencepieces.Model, "written", lambda self: {
        i: b.replace("▁text".encode(), b"") for i, b in whole(self).items()})
    assert told().count((0, False)) == 2


def test_viterbi_of_a_unigram_model(spark):
    pieces = [("▁", -2.0), ("a", -1.5), ("b", -1.6), ("ab", -2.0), ("ba", -1.9), ("▁a", -2.2), ("aba", -3.1)]
    model = sentencepieces.Model(sentencepieces.UNIGRAM, tuple((p, s, i) for i, (p, s) in enumerate(pieces)),
                                 (), 99)
    words = ["▁abab", "▁ba", "abba", "▁azb", "b"]
    got = {r.word: r.ids for r in sentencepieces.encode_words(
        spark.createDataFrame([(w,) for w in words], "word string"), model).collect()}
    cost = {p: (-s, i) for i, (p, s) in enumerate(pieces)}
    low = 3.1 + sentencepieces.UNKNOWN_PENALTY

    def best(w):
        if not w:
            return 0.0, []
        found = []
        for n in range(1, len(w) + 1):
            c = cost.get(w[:n], (low, 99) if n == 1 else None)
            if c:
                rest = best(w[n:])
                found.append((c[0] + rest[0], [c[1], *rest[1]]))
        return min(found)
    for w in words:
        total = sum(low if i == 99 else -pieces[i][1] for i in got[w])
        assert math.isclose(total, best(w)[0])


def test_sharding(docs, none):
    got = sharding.shard_documents(docs, [1.0] * 24).collect()
    assert len(got) == len(ROWS)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted(((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in ROWS), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == want
    assert sharding.shard_documents(none, [1.0] * 24).count() == 0


def test_shard_weights(spark):
    keys = spark.range(30000).select("id", sharding.rendezvous_shard(["id"], [1.0, 2.0, 3.0]).alias("s"))
    n = {r.s: r["count"] for r in keys.groupBy("s").count().collect()}
    assert [round(n[i] / 5000, 1) for i in range(3)] == [1.0, 2.0, 3.0]


def test_chat_round_trip_and_mask(spark):
    nasty = ["", None, "a &lt; b & <turn:user>", "</turn>\n<turn:assistant>x", "\\### Assistant: </turn> ok", "ü\n\n"]
    turns = [(c, t, "assistant" if t % 2 else "user", nasty[(c + t) % 6]) for c in range(6) for t in range(7)]
    turns += [(1, 3, "assistant", nasty[4]), (None, 0, None, "who"), (9, None, "user", "x")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4)
    df = df.withColumn("parts", chat.text_parts(df["text"])).withColumn("body", df["role"])
    out = {r.conv_id: r for r in chat.conversation_digests(chat.format_conversations(df)).collect()}
    groups = defaultdict(list)
    for c, t, role, text in turns:
        groups[c].append((t is not None, t or 0, role or "", text or ""))
    esc = lambda s: s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    for c, rows in groups.items():
        rows = [(r, x) for *_, r, x in sorted(rows, key=lambda r: (r[:3], esc(r[3])))]
        said = "".join(x for r, x in rows if r == "assistant")
        r = out[c]
        assert r.n_turns == len(rows)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in rows).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert r.formatted_chars == sum(len(esc(a)) + len(esc(b)) + 15 for a, b in rows)
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_attachments(spark):
    part = lambda **k: {**dict.fromkeys(["kind", "text", "ref", "width", "height", "seconds", "pages"]), **k}
    content = [part(kind="text", text="see <this>"), part(kind="image", ref="i.png", width=57, height=28),
               part(kind="audio", ref="a.wav", seconds=2.0), part(kind="document", ref="d.pdf", pages=2),
               part(kind="video", ref="v")]
    df = spark.createDataFrame([(1, 0, "user", content), (1, 1, "assistant", []), (1, 2, "user", None)],
                               f"conv_id long, turn long, role string, parts {chat.PARTS}")
    r = chat.format_conversations(df).first()
    assert r.formatted.startswith("<turn:user>see &lt;this&gt;<image:1/><audio:2/><document:3/><unknown:4/></turn>\n")
    assert [(a.turn_no, a.part, a.kind, a.ref, a.tokens) for a in r.attachments] == [
        (0, 1, "image", "i.png", 3), (0, 2, "audio", "a.wav", 25), (0, 3, "document", "d.pdf", 1200),
        (0, 4, "video", "v", 0)]
    assert r.attachment_tokens == 1228


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        odd = [int(x) * (1 + i % 2) for i, x in enumerate(d[::-1])]
        return 16 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in odd) % 10 == 0
    return kind != "phone" or 8 <= len(d) <= 15


def test_plain_personal_data_equals_the_patterns():
    rng = random.Random(5)
    for alphabet in ("ab1@.-+ 0(5", "0123456789 -.", "4111 -", "+123456789 ()"):
        for _ in range(2000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 45)))
            found = pii.plain_spans(t)
            for kind, pattern in PLAIN.items():
                assert found[kind] == [m.span() for m in re.finditer(pattern, t) if valid(kind, m[0])], t


@pytest.mark.parametrize("text,kind,span", [
    ("mail bob [at] example [dot] com now", "email", "bob [at] example [dot] com"),
    ("write to bob at example dot com today", "email", "bob at example dot com"),
    ("jоhn@example.com", "email", "jоhn@example.com"),
    ("a​b@ex​ample.com", "email", "a​b@ex​ample.com"),
    ("１９２.168.0.1", "ip", "１９２.168.0.1"),
    ("ip one nine two dot one six eight dot zero dot one end", "ip", "one nine two dot one six eight dot zero dot one"),
    ("call plus one five five five one two three four five six seven ok", "phone",
     "plus one five five five one two three four five six seven"),
    ("card four one one one one one one one one one one one one one one one", "card",
     "four one one one one one one one one one one one one one one one")])
def test_disguised_personal_data(text, kind, span):
    _, every = pii.all_spans(text)
    assert span in [text[a:b] for a, b in every[kind]]
    assert span not in pii.mask(text, pii.written(every))


def test_gate_never_hides_a_disguised_find():
    for text, kind in (("card 4 one 1 one 1 one 1 one 1 one 1 one 1 one 1 one", "card"),
                       ("call +1 five 5 five 0 one 2 three 4 now", "phone"),
                       ("card four one one one one one one one one one one one one one one one".replace("one", "ONE"), "card"),
                       ("call plus one fıve ſix five 0 one 2 three 4 now", "phone")):
        assert pii.disguised_spans(text)[kind]
    rng = random.Random(6)
    parts = ["1", "4", "42", "one", "Four", "oh", "ſix", "fıve", "NİNE", "plus", "+1", "dot", "at", "@", "x", "stone", "[at]", "(", ")"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) + rng.choice([" ", " ", "-", ", ", "", "."]) for _ in range(rng.randint(2, 24)))
        assert pii.disguised_spans(text) == pii.disguised_spans(text, gated=False), text


def test_clean_text_has_no_finds():
    for text in ("look at the example.com page", "we saw one two three birds", "a dot on the map at noon", "été à 10.5"):
        assert pii.written(pii.all_spans(text)[1]) == ""


def test_personal_data_table(docs, none):
    got = pii.find_personal_data(docs)
    assert got.count() == len(ROWS) and got.filter("spans != ''").count() == 0
    assert pii.find_personal_data(none).count() == 0


def test_quality_measures_and_base(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (999999, 0, 0), (2, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {(r.doc_id, r.word_chars): r for r in quality.judge_documents(docs, labels).collect()}
    for r in ROWS:
        t = r[1] or ""
        ws = WORDS.findall(t)
        count = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
        covered = {j for i in range(len(ws) - 7) if count[tuple(ws[i:i + 8])] > 1 for j in range(i, i + 8)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORDS.search(line):
                dup += line in seen
                seen.add(line)
        g = got[r[0], sum(map(len, ws))]
        assert (g.n_words, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (
            len(ws), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered))
        failed = len(ws) < 20 or 100 * len(covered) > 30 * len(ws)
        assert g.base_failed == failed and g.kept == (not failed)  # too few labels prove nothing
    kept = quality.filter_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in quality.judge_documents(docs, labels).collect())
    assert quality.judge_documents(none, labels).count() == 0
    assert quality.filter_documents(docs, labels.limit(0)).count() == kept.count()


def test_quality_cutoffs_catch_junk_and_keep_their_promise(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    rows, marks = [], []
    for i in range(3000):
        bad = i % 4 == 0
        rows.append((i, " ".join(word() + ("$$$" if bad else "") for _ in range(30)), "en"))
        marks.append((i, 0 if bad else 1, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in quality.judge_documents(docs, labels).collect()}
    assert not any(got[i] for i in got if i % 4 == 0)
    assert sum(not got[i] for i in got if i % 4) <= 0.05 * 2250


def test_binomial_bound_is_exact():
    tail = sum(math.comb(50, k) * 0.1 ** k * 0.9 ** (50 - k) for k in range(3))
    assert math.isclose(quality.at_most(2, 50, 0.1), tail, rel_tol=1e-9)
    assert math.isclose(quality.upper_bound(0, 100, 0.05), 1 - 0.05 ** (1 / 100), rel_tol=1e-6)
    good, bad = np.zeros(51), np.zeros(51)
    good[3], good[40], bad[30] = 995, 5, 100
    assert quality.proven_cutoff(good, bad, 0.02, 0.001, 1.0) == 30
    assert quality.proven_cutoff(good[:] / 100, bad, 0.02, 0.001, 1.0) is None


def test_line_dedup(spark, docs, none):
    got = line_dedup.line_groups(docs).collect()
    norm = lambda s: re.sub(r"[\x20\x09-\x0D]+", " ", s.lower()).strip(" ")
    lines = {}
    for r in ROWS:
        for i, line in enumerate((r[1] or "").split("\n")):
            if norm(line):
                lines[r[0], i] = norm(line)
    at = {(r.doc_id, r.line_no): r for r in got}
    assert set(at) == set(lines)
    same = defaultdict(set)
    for k, r in at.items():
        same[lines[k]].add((r.keep_doc, r.keep_line))
        assert r.kept == (k == (r.keep_doc, r.keep_line))
    assert all(len(s) == 1 for s in same.values())
    assert line_dedup.line_groups(none).count() == 0
    out = line_dedup.drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)


def test_fuzzy_lines_join_and_far_ones_do_not(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [[word() for _ in range(201)] for _ in range(20)]
    rows = []
    for i, ws in enumerate(base):
        rows += [(i, " ".join(ws)), (100 + i, " ".join(ws).upper() + "  "), (200 + i, " ".join([*ws, "x"]))]
    got = {r.doc_id: r for r in line_dedup.line_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[100 + i].keep_doc == i for i in range(20))
    assert sum(got[200 + i].keep_doc == i for i in range(20)) >= 10
    assert all(r.keep_doc % 100 == d % 100 for d, r in got.items())


def test_fingerprints_are_made_inside_the_row(spark):
    """63 bits as counted plainly, for lines of few and of many words, and without a shuffle."""
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n)))
            for i, n in enumerate([1, 2, 3, 4, 8, 100, 254, 255, 256, 257, 300, 3000])]
    told = line_dedup.fingerprints(line_dedup.lines_of(
        spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text"))
    assert "Exchange" not in told._jdf.queryExecution().executedPlan().toString()
    h = lambda value, seed=42: xxhash.xxh64_intdigest(value, seed=seed)
    signed = lambda x: x - (x >> 63 << 64)
    for r in told.collect():
        words = [h(w.encode()) for w in set(rows[r.at.doc][1].split())]
        low, high = (struct.pack("<q", f(map(signed, words))) for f in (min, max))
        tie, votes = h(high, h(low)), [sum(x >> j & 1 for x in words) for j in range(63)]
        assert r.sim == sum((2 * v > len(words) or (2 * v == len(words) and tie >> j & 1)) << j
                            for j, v in enumerate(votes))


def test_parts_of_the_block_keys_share_none(spark):
    lines = line_dedup.fingerprints(line_dedup.lines_of(spark.createDataFrame(
        [(i, f"line number {i % 50} of these, and {i} words") for i in range(200)], "doc_id long, text string"),
        "doc_id", "text"))
    parts = [p.select("key").distinct().collect() for p in line_dedup.block_keys(lines)]
    assert len(parts) == 3 and all(parts) and len({r.key for p in parts for r in p}) == sum(map(len, parts))


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_fuzzy_lines_recall_against_brute_force(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    texts = []
    for n in [3, 4, 5, 8, 10, 10, 15, 20, 20, 30] * 4:
        line = [rng.choice(vocabulary) for _ in range(n)]
        texts.append(" ".join(line))
        line[rng.randrange(n)] = rng.choice(vocabulary)
        texts.append(" ".join(line))
        at = rng.randrange(len(texts[-2]))
        texts.append(texts[-2][:at] + "#" + texts[-2][at + 1:])
    got = {r.doc_id: r.keep_doc for r in line_dedup.line_groups(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    near = [(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts[:i])
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b))
            and 5 * edit_distance(a, b) <= max(len(a), len(b))]
    assert len(near) > 80 and sum(got[i] == got[j] for i, j in near) >= 0.95 * len(near)
    assert all(i // 3 == k // 3 for i, k in got.items())


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_jaccard_components(docs, none, width, percent):
    got = jaccard_join.jaccard_components(docs, width, percent).collect()
    sets = {}
    for r in ROWS:
        ws = words_of(r[1])
        if r[0] is not None:
            sets[r[0]] = {tuple(ws[i:i + width]) for i in range(max(1, len(ws) - width + 1))} if ws else set()
    above = {i: i for i in sets}

    def root(i):
        while above[i] != i:
            i = above[i]
        return i
    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                above[b] = a
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root(r.doc_id))
    assert len(got) == len(ROWS)
    assert jaccard_join.jaccard_components(none, width, percent).count() == 0
    one = jaccard_join.keep_one_of_each(docs, width=width, percent=percent)
    assert one.columns == docs.columns
    assert {r.doc_id for r in one.collect()} == {None, *(root(i) for i in ids)}


def test_jaccard_blocks_and_second_round(spark, monkeypatch):
    """Chains of near copies, in tiny blocks: links that only the second round finds are kept."""
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 3)
    rng = random.Random(4)
    texts = []
    for g in range(4):
        ws = [f"g{g}w{i}" for i in range(40)]
        for _ in range(12):
            texts.append(" ".join(ws))
            ws[rng.randrange(40)] = f"n{rng.random()}"
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(
        spark.createDataFrame(rows, "doc_id long, text string"), 1, 93).collect()}
    sets = [set(t.split()) for t in texts]
    above = list(range(len(texts)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 93 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                above[b] = a
    assert got == {i: root(i) for i in range(len(texts))}


def test_signature_tree_drops_no_linked_pair():
    rng = np.random.default_rng(0)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 2 ** 63, rng.integers(5, 400)).astype(np.uint64)
        for _ in range(3):
            keep = base[rng.random(len(base)) > rng.random() * 0.15]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 2 ** 63, 2).astype(np.uint64)])))
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    tree = SignatureTree(n, [signature(s) for s in sets], np.ones(len(sets), bool), np.arange(len(sets)), 85)
    told = set(tree.pairs())
    linked = {(i, j) for j in range(len(sets)) for i in range(j)
              if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
    assert linked <= told and len(told) < len(sets) ** 2 / 10
    assert set(tree.pairs(lambda i: 0)) == set()


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (5, 5), (None, 3)]
    got = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.v: r.component for r in got} == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 7: 5, 8: 5, 9: 5}
    assert len(got) == 8


def test_mixing(docs, none):
    got = mixing.mix_plan(docs, block_rows=16).collect()
    assert sorted(((r.doc_id, r.size) for r in got), key=repr) == sorted(
        ((r[0], len(WORDS.findall(r[1] or ""))) for r in ROWS), key=repr)
    size = Counter()
    for r in ROWS:
        size[r[3]] += len(WORDS.findall(r[1] or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(size.values()), {}, set(order)
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * size[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = 2.0 * size[s]
            left -= target[s]
        open_ -= full
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.taken <= 2 * r.size and r.source_size == size[r.source]
        assert math.isclose(r.target, target[r.source], rel_tol=1e-9)
    for s in order:
        assert abs(taken[s] - target[s]) <= max(40001, 0.05 * target[s])
    again = mixing.mix_plan(docs.repartition(3), block_rows=16).collect()
    key = lambda rows: sorted(((r.doc_id, r.size, r.taken) for r in rows), key=repr)
    assert key(again) == key(got)
    assert mixing.mix_plan(none).count() == 0
    assert mixing.mix_documents(docs).columns == docs.columns


def test_flight_keeps_totals_and_means():
    rng = np.random.default_rng(1)
    size = np.sort(rng.lognormal(4, 1, 300).astype(int))[::-1]
    p = np.full(300, 0.37)
    q = mixing.flight(p, size, rng)
    assert ((q > 1e-9) & (q < 1 - 1e-9)).sum() <= 2
    assert abs(q.sum() - p.sum()) < 1e-6 and abs((q - p) @ size) < 1e-3
    assert abs((mixing.landing(q, size, rng) - p) @ size) <= 2 * size[-5:].max()
    small = np.arange(12, 0, -1)
    mean = np.mean([mixing.landing(mixing.flight(np.full(12, 0.3), small, rng), small, rng) for _ in range(1500)], 0)
    assert np.abs(mean - 0.3).max() < 0.06


def test_a_written_step_leaves_no_shuffle_files(spark):
    """Disk holds the shuffles of one step at a time; the session's own setting is put back."""
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    held = lambda: set(re.findall(r"shuffle_\d+", manager.getAllBlocks().mkString(" ")))
    was, before = spark.conf.get(CLEANUP), held()
    df = materialise(spark.range(20_000).groupBy(F.xxhash64("id")).count(), "test-shuffle")
    until = time.time() + 20
    while held() - before and time.time() < until:
        time.sleep(0.2)
    assert not held() - before and spark.conf.get(CLEANUP) == was
    assert df.count() == 20_000


def test_signatures_are_short():
    """They travel once for each block pair of a document: two bits a shingle at most."""
    assert all(len(signature(np.arange(n, dtype=np.uint64))) <= max(8, n / 4) for n in (1, 70, 400, 5000))
