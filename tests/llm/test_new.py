"""Operators 11 to 13 against brute force and held-out rows; odd rows and clashing names of all."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderflow.llm import (alignment, bigru, exact_dedup, lookup_shards, mixing, packing, prefix_trie, queries, simhash, surrogates,
                           toxicity)

A_PATH, B_PATH = queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model")


def aligned_by_hand(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    from orderflow.llm.token_fst import byte_names

    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    raw = {c: x for x, c in byte_names().items()}
    token = {i: bytes(raw[c] for c in t) for t, i in a.get_vocab().items()}
    done, counts = [], collections.Counter()
    for i, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [token[x] for x in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode() for x in ids_b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        ends = dict(zip(np.cumsum([len(x) for x in bytes_a]).tolist(), range(len(ids_a))))
        links = [(ends[e], k) for k, e in enumerate(np.cumsum([len(x) for x in bytes_b]).tolist()) if e in ends]
        groups, at = [], (0, 0)
        for x, y in links:
            groups.append(",".join(map(str, ids_a[at[0]:x + 1])) + "|" + ",".join(map(str, ids_b[at[1]:y + 1])))
            at = (x + 1, y + 1)
        pairs = [(ids_a[x], ids_b[y]) for x, y in links]
        counts.update(pairs)
        done.append((i, len(ids_a), len(ids_b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    high = collections.Counter()
    for (_, y), n in counts.items():
        high[y] = max(high[y], n)
    return collections.Counter((i, na, nb, g, len(p), sum(counts[x] == high[x[1]] for x in p), sum(counts[x] for x in p), h)
                               for i, na, nb, g, p, h in done)


def aligned(df, **options):
    rows = alignment.align(df, A_PATH, B_PATH, **options)
    return collections.Counter(tuple(r) for r in rows.select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


def test_alignment_equals_brute_force_on_odd_texts(spark):
    rnd = random.Random(1)
    bits = ["a", "the", " ", "  ", "\n", "\t", " ", "\x1c", "é", "é", "漢字", "▁", "<s>", "<|endoftext|>", "<0x0A>", "'s", "123",
            "😀", "x" * 70, "\x00", "ing", " of", "ﬁ", "\r\n"]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randrange(25)))) for i in range(600)]
    rows += [(9, None), (9, None), (None, "of the"), (None, "of the"), (5, "of the"), (7, "word " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("digest", "block", "id", "pairs", "copies"):
        df = df.withColumn(c, F.lit(1))
    assert aligned(df, block_pairs=300) == aligned_by_hand(rows)
    assert not aligned(df.limit(0))


def trie_by_hand(rows):
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append(((t is not None, t or 0), r, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()[:32], x))
    own = {c: [(r, x) for _, r, _, x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - c % 5 if c >= 0 else c + -c % 5
        rebuilt[c] = own.get(base, [])[:h] + s[h:]
    members = collections.defaultdict(list)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = collections.Counter()
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(p))))
        out[(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
             hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def test_trie_equals_brute_force_whatever_bursts(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(c, rnd.choice([t, t, None, 0]), rnd.choice(["u", "a", None]), rnd.choice(["x", "x", "é", "", None]))
            for c in rnd.sample(range(-50, 400), 200) for t in range(rnd.randrange(12))]
    rows += [(None, 1, "u", "x"), (7, None, None, None)] + [(1000 + i, 0, "u", "same") for i in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit(1)).withColumn("key", F.lit(1))
    monkeypatch.setattr(prefix_trie, "PART_BYTES", 50)
    want = trie_by_hand(rows)
    conversations = prefix_trie.share_first_turns(prefix_trie.turn_sequences(df))
    for most in (8, 10 ** 6):
        assert collections.Counter(tuple(r) for r in prefix_trie.trie(conversations, most).collect()) == want
    assert prefix_trie.trie(prefix_trie.share_first_turns(prefix_trie.turn_sequences(df.limit(0)))).count() == 0


def test_gradients_are_those_of_the_loss():
    net = bigru.BiGru.new(["x", "y", "z"], units=4, seed=2)
    rng = np.random.default_rng(0)
    x = rng.integers(1, 256, (9, 5)).astype(np.uint8)
    x[6:, 0] = bigru.PAD
    wanted = np.array([0, 1, 2, 0, 1])
    for part in (net.forward, net.backward, net.out):
        for k in part:
            part[k] = part[k].astype(np.float64)
    _, grads = net.loss_and_gradients(x, wanted)
    for part, grad in zip((net.forward, net.backward, net.out), grads):
        for k, g in grad.items():
            for at in [np.unravel_index(np.abs(g).argmax(), g.shape), np.unravel_index(rng.integers(g.size), g.shape)]:
                kept, step = part[k][at], 1e-2
                part[k][at] = kept + step
                up, _ = net.loss_and_gradients(x, wanted)
                part[k][at] = kept - step
                down, _ = net.loss_and_gradients(x, wanted)
                part[k][at] = kept
                assert abs((up - down) / (2 * step) - g[at]) < 2e-3 * max(1, abs(g[at]))


def test_language_of_held_out_rows_and_odd_texts(spark):
    sf = "/root/testdata/sf0.01"
    docs = queries.table(spark, sf, "documents").select("doc_id", "lang")
    got = queries.op13_language_id(spark, sf).join(docs, "doc_id").collect()
    out = [r.lang == r.lang_pred for r in got if r.held_out]
    assert len(got) == 1000 and len(out) > 200 and np.mean(out) >= 0.98
    assert all(0 <= r.score <= 1 for r in got)
    df = spark.createDataFrame([(1, None, "en"), (1, "", "en"), (None, "12 34", "de"), (5, "hello", None), (5, "x" * 300_000, "q")],
                               "doc_id long, text string, lang string").withColumn("letters", F.lit(3)).withColumn("rank", F.lit(3))
    net = bigru.train(df, F.lit(True))
    assert net.languages == ["q"]
    rows = [tuple(r) for r in bigru.identify(df, net).collect()]
    assert rows == [(1, "und", 0), (1, "und", 0), (None, "und", 0), (5, "q", 1), (5, "q", 1)]
    none = bigru.train(df.limit(0), F.lit(True))
    assert {r.lang for r in bigru.identify(df, none).collect()} == {"und"}
    assert bigru.identify(df.limit(0), net).count() == 0


def test_windows_label_every_byte_of_a_text():
    net = bigru.BiGru.new(["x", "y"], units=4)
    data = np.random.default_rng(1).integers(1, 256, 1000).astype(np.uint8)
    bounds = np.array([0, 0, 5, 700, 1000])
    got = net.pooled(data, bounds, window=64)
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        parts = [net.label(data[k:min(k + 64, b)][:, None])[:, :, 0] for k in range(a, b, 64)]
        want = np.concatenate(parts).mean(axis=0) if parts else np.full(2, 0.5)
        # a short window is padded, which the backward layer reads
        assert np.allclose(got[i], want, atol=1e-6) or (b - a) % 64


def test_words_of_odd_texts_are_the_librarys():
    import pyarrow as pa

    words = packing.WordTokens(queries.vocabulary("word_bpe_49k.json"))
    rnd = random.Random(2)
    bits = ["a", "the", " ", "  ", "\n", " ", "\x1c", "é", "é", "漢字", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "123", "😀", "x" * 70,
            "\x00", "Of", "ß", "ẞ", "İ", "ÿ", ".", ",", "!?", "ſ", "\x85", "Å"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(25))) for _ in range(1500)] + ["", "word " * 50_000]
    for _ in range(2):  # the second time from memory
        ids, bounds = words.encode(pa.array(texts))
        for i, t in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == words.library.encode(t, add_special_tokens=False).ids
    words.chars = packing.MEMO_CHARS + 1
    assert words.encode(pa.array(["of the"]))[0].tolist() == words.library.encode("of the", add_special_tokens=False).ids


def test_packing_worker_holds_little(monkeypatch):
    """Words that are remembered, and texts split at a time, stay few: the
    pipeline's executors are full of other stages' memory when they pack."""
    import pyarrow as pa

    words = packing.WordTokens(queries.vocabulary("word_bpe_49k.json"))
    monkeypatch.setattr(words, "_model_tokens", lambda word: [])
    held = 0
    for part in range(120):
        names = [chr(97 + part // 26) + chr(97 + part % 26) + "".join(chr(97 + i // 26 ** k % 26) for k in range(9)) for i in range(5000)]
        words.encode(pa.array(names))
        held = max(held, sum(map(len, words.known)))
    assert held < 5_000_000 and packing.AT_ONCE <= 1 << 20 and packing.DONE_AT_ONCE <= 512


def test_entities_without_letters_and_full_shapes_get_surrogates(spark):
    texts = ['password: "********"', "write to __@--.com now"] + [f"host {a}.{b}.{c}.{d}" for a in range(1, 10) for b in range(4) for c in range(10) for d in range(10)]
    rows = surrogates.replace(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), b"k").collect()
    by = {r.id: r for r in rows}
    assert "********" not in by[0].text and "__@--.com" not in by[1].text
    used = [e.surrogate for r in rows for e in r.entities]
    real = {t.split()[-1] for t in texts[2:]}
    hosts = [e.surrogate for r in rows for e in r.entities if e.type == "IPV4"]
    assert len(set(hosts)) == len(hosts) == len(real) and not real & set(hosts) and len(used) == len(rows)


def test_no_free_surrogate_is_said(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "surrogate", lambda kind, canon, key, attempt=0: "same")
    monkeypatch.setattr(surrogates, "MOST_DRAWS", 1)
    found = spark.createDataFrame([("SSN", "123"), ("SSN", "456"), ("SSN", "789")], "kind string, canon string")
    with pytest.raises(ValueError, match="SSN of the shape '999'"):
        surrogates.settled(found, b"k")


CLASHING = ["row", "__row", "c0", "__score", "slot", "shard", "id", "text_key", "__text", "size"]


@pytest.fixture()
def clashing(spark):
    texts = ["of the end", "of  the end", "of the end", None, "", "other words here " * 30, "of the end and more"]
    df = spark.createDataFrame([(i, t, "en", "ab"[i % 2], 7) for i, t in enumerate(texts)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    for c in CLASHING:
        df = df.withColumn(c, F.lit(7))
    return df


def test_clashing_names_change_nothing(spark, clashing):
    plain = clashing.drop(*CLASHING)
    labels = spark.createDataFrame([(i, int(i == 5)) for i in range(7)], "doc_id long, toxic int")
    steps = [exact_dedup.drop_exact_copies, simhash.keep_one_per_group, mixing.take_mix, lambda d: toxicity.rejected(spark, d, labels)]
    for step in steps:
        got = step(clashing)
        assert got.columns == clashing.columns
        same = sorted(map(str, got.select(*plain.columns).collect()))
        assert same == sorted(map(str, step(plain).collect()))
        assert all(r[c] == 7 for r in got.collect() for c in CLASHING)
        assert step(clashing.limit(0)).count() == 0
    assert sorted(r.group_size for r in exact_dedup.exact_groups(clashing).collect()) == [1, 1, 2, 2, 3, 3, 3]
    table = lookup_shards.lookup_table(spark, ("x", "y"), 7)
    placed = lookup_shards.place(clashing, "doc_id", table, 7)
    assert placed.columns == [*clashing.columns, "slot_", "shard_"]
    assert {(r.doc_id, r.slot_, r.shard_) for r in placed.collect()} == \
        {(r.doc_id, r.slot, r.shard) for r in lookup_shards.place(plain, "doc_id", table, 7).collect()}


def test_without_labels_every_text_scores_the_prior(spark, clashing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    index = toxicity.fit(clashing, none)
    assert {round(r.score, 3) for r in toxicity.score(clashing, index).collect()} == {0.0}
    assert toxicity.rejected(spark, clashing, none).count() == 7


def test_pipeline_stages_on_odd_rows(spark, clashing):
    docs = clashing.select(*corpus_pipeline.COLUMNS)
    sf = "/root/testdata/sf0.001"
    odd = docs.unionByName(spark.createDataFrame([(None, None, None, None, None), (None, " \n", None, None, 2)], docs.schema))
    for rows in (odd, odd.limit(0)):
        left = rows
        for name, stage in corpus_pipeline.STAGES:
            left = stage(spark, left, sf)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert left.columns == corpus_pipeline.COLUMNS
            assert (left.count() == 0) == (rows.count() == 0)
