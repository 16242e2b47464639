"""Near-duplicates, tokenizers, language ID, quality and the pipeline."""

import hashlib
import io
import math
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from quillmill.llm import byte_bpe, filters, language_id, near_dedup, quality, ragged, spans, token_files

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string, rep string"
ODD = ["", None, " ", "\n\n", "a", "A b", "\x1c x", "日本 語", "x y  z", "  lead", "tail  ", "😀😀", "the " * 4000, "q" * 3000, "é́", "a b　\n c", "it's we'll 12²Ⅷ"]


def _sets(texts):
    out = []
    for t in texts:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def _components(ids, sets, percent=75):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in range(len(ids)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and 100 * both >= percent * len(sets[x] | sets[y]):
                a, b = sorted((find(ids[x]), find(ids[y])))
                parent[b] = a
    return {i: find(i) for i in ids}


def _near_fixture():
    rng = random.Random(7)
    words = ["w%d" % i for i in range(300)]
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(6, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(rng.choice([" ", "\n", "  "]).join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    texts += ["a b", "A  B", "a b c", "hello", None, "", " \n", "Été x", "été x"]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("small", [False, True])
def test_near_dedup(spark, monkeypatch, small):
    if small:  # deeper regions, blocks and pairs of blocks
        monkeypatch.setattr(near_dedup, "REGION", 2)
        monkeypatch.setattr(near_dedup, "CLUSTER_CLASSES", 2)
    texts = _near_fixture()
    ids = list(range(100, 100 + len(texts)))
    rows = [(i, t, "x") for i, t in zip(ids, texts, strict=True)]
    out = near_dedup.near_groups(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    sets = _sets(texts)
    want = _components(ids, sets)
    assert {r["doc_id"]: r["component_id"] for r in out} == want
    assert {r["doc_id"]: r["n_shingles"] for r in out} == {i: len(s) for i, s in zip(ids, sets, strict=True)}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def _hidden_pair():
    """A near-duplicate pair, and texts unlike it: in each tree that the pair shares, 200 of them have its common prefix too."""
    rng = random.Random(3)
    fresh = lambda n: " ".join("r%d" % rng.randrange(10**9) for _ in range(n))

    def signed(texts):
        return near_dedup.minhash(*near_dedup.shingle_sets([t.encode() for t in texts]))

    words = fresh(120).split(" ")
    pair = [" ".join(words[:107]), " ".join(words[13:])]  # 90 of 116 shingles
    pieces = [" ".join(words[i : i + 5]) for i in range(116)]
    low, both = signed(pieces).argmin(axis=0), signed(pair)
    same, texts = both[0] == both[1], []
    for t in range(near_dedup.TREES):
        slots = range(t * near_dedup.DEPTH, (t + 1) * near_dedup.DEPTH)
        depth = next((d for d, k in enumerate(slots) if not same[k]), near_dedup.DEPTH)
        if depth >= near_dedup.FIRST_DEPTH:
            shared = list(slots)[:depth]
            needed = sorted({int(low[k]) for k in shared})
            made = [" ".join(f"{fresh(2)} {pieces[i]}" for i in needed) for _ in range(4000)]
            fits = (signed(made)[:, shared] == both[0, shared]).all(axis=1)
            assert fits.sum() >= 200
            texts += [made[i] for i in np.flatnonzero(fits)[:200]]
    return pair, texts


def test_near_dedup_pair_in_large_regions(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "REGION", 4)
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    pair, others = _hidden_pair()
    rows = [(i, t, "x") for i, t in enumerate([*pair, *others])]
    out = near_dedup.near_groups(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    want = _components([r[0] for r in rows[:2]], _sets(pair))
    assert want == {0: 0, 1: 0}
    assert {r["doc_id"]: r["component_id"] for r in out} == want | {r[0]: r[0] for r in rows[2:]}


def test_near_dedup_many_pairs_in_large_regions(spark, monkeypatch):
    """Pairs that are linked only with each other, behind boilerplate that all texts share."""
    monkeypatch.setattr(near_dedup, "REGION", 16)
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(12)
    shared = " ".join("s%d" % i for i in range(60))
    texts = []
    for _ in range(300):
        own = ["o%d" % rng.randrange(10**9) for _ in range(60)]
        texts += [f"{shared} {' '.join(own)}", f"{shared} {' '.join(own[:-4])}"]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    out = near_dedup.near_groups(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == {i: i // 2 * 2 for i in range(600)}


def test_near_dedup_very_long_texts(spark):
    rng = random.Random(13)
    words = ["v%d" % rng.randrange(10**6) for _ in range(300_000)]
    edited = list(words)
    for i in rng.sample(range(len(words)), 5_000):
        edited[i] = "edit"
    rows = [(1, " ".join(words), ""), (2, " ".join(edited), ""), (3, " ".join(reversed(words)), "")]
    out = near_dedup.near_groups(spark.createDataFrame(rows, DOCS)).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == {1: 1, 2: 1, 3: 3}


def test_near_dedup_odd_rows(spark):
    assert near_dedup.near_groups(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(1, "a b c d e f", ""), (1, "a b c d e f", ""), (None, "a b c d e f", ""), (2, "A B C D E F", ""), (3, None, "")]
    out = near_dedup.near_groups(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in out) == [(0, 0), (1, 1), (1, 1), (2, 1), (3, 3)]


def test_shingles_are_sets():
    texts = [t or "" for t in ODD] + [t or "" for t in _near_fixture()] + ["x" * 400 + " y z", "x" * 399 + "w y z"]
    flat, offsets = near_dedup.shingle_sets([t.encode() for t in texts])
    sets = _sets(texts)
    assert np.diff(offsets).tolist() == [len(s) for s in sets]
    known = {}
    for i, s in enumerate(sets):
        mine = frozenset(flat[offsets[i] : offsets[i + 1]].tolist())
        assert known.setdefault(mine, s) == s
    assert len(known) == len({frozenset(s) for s in sets})


@pytest.fixture(scope="module")
def reference_bpe():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})


def test_bpe_column(spark, reference_bpe):
    rng = random.Random(8)
    marks = ["a", "the", " ", "  ", "\n", "'s", "'ll", "é", "漢", "😀", "1", "²", "_", "!", "\x1c", " ", "　", "日本", "​", "\u0085"]
    texts = ODD + ["".join(rng.choice(marks) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = df.select("doc_id", "ids", byte_bpe.encode_column(F.col("text"), RANKS).alias("out"))
    got = got.withColumn("back", byte_bpe.decode_column(F.col("out"), RANKS)).collect()
    for r in got:
        text = texts[r["doc_id"]] or ""
        assert r["out"] == reference_bpe.encode_ordinary(text), repr(text)
        assert bytes(r["back"]) == text.encode()
    assert df.limit(0).select(byte_bpe.encode_column(F.col("text"), RANKS)).count() == 0


def test_prefix_table_appends_and_edits():
    v = byte_bpe.Vocabulary(byte_bpe.load_ranks(RANKS))
    rng = random.Random(9)
    pick = lambda n: bytes(rng.choice(b"abthe ionrs\xc3\xa9") for _ in range(n))
    merged = lambda data: [v.ranks[p] for p in v.merged(data)]
    made = []
    for _ in range(40):
        data = pick(400)
        table = byte_bpe.PrefixTable(v, data[:100])
        table.append(data[100:])
        assert table.tokens() == merged(data)
        i = rng.randint(0, 399)
        j = min(400, i + rng.randint(0, 5))
        new = pick(rng.randint(0, 6))
        made.append(table.edit(i, j, new) - (400 - i))
        assert table.tokens() == merged(data[:i] + new + data[j:])
    assert min(made) < -50  # an edit stops early


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 31])
def test_pack(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 2**bits, n)
        data = token_files.pack(ids, bits)
        assert len(data) == -(-n * bits // 8)
        assert (token_files.unpack(data, bits, n) == ids).all()


def test_file_random_access():
    rng = np.random.default_rng(3)
    counts = np.array([5, 0, 9000, 1, 4096])
    ids = rng.integers(0, 49408, counts.sum())
    out = io.BytesIO()
    writer = token_files.TokenWriter(out, 17)
    for a, b in ((0, 2), (2, 5)):  # documents come in chunks
        writer.add([3, None, 7, 7, 9][a:b], counts[a:b], ids[counts[:a].sum() : counts[:b].sum()])
    writer.close()
    f = token_files.TokenFile(out, out.tell())
    ends = np.cumsum(counts)
    for i, (a, b) in enumerate(zip(ends - counts, ends, strict=True)):
        assert (f.document(i) == ids[a:b]).all()
    assert (f.ids(4090, 20) == ids[4090:4110]).all()
    assert f.table(0, 5)[:, 1].tolist() == [0, 1, 0, 0, 0, 0] and f.table(0, 5)[:, 0].tolist()[:5] == [3, 0, 7, 7, 9]
    with pytest.raises(ValueError):
        token_files.TokenFile(io.BytesIO(b"x" * 100), 100)
    with pytest.raises(ValueError):
        token_files._filesystem("abfss://a/b")


@pytest.mark.parametrize("small", [False, True])
def test_token_files(spark, tmp_path, monkeypatch, small):
    from tokenizers import Tokenizer

    if small:  # several files a part, several pieces a document (4,001 ids and more)
        monkeypatch.setattr(token_files, "FILE_DOCS", 2)
        monkeypatch.setattr(token_files, "CHUNK", 1)
        monkeypatch.setattr(token_files, "BLOCK", 8)
        monkeypatch.setattr(token_files, "PIECE", 16)
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(3, "again", "x"), (3, "again", "x"), (None, "no id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    files = token_files.write_token_files(df, f"file://{tmp_path}/t", path, 49408, 1)
    assert files.count() <= 4 or small
    out = token_files.read_token_files(files).collect()
    want = sorted(((-1 if i is None else i, t or "") for i, t, _ in rows))
    start = 0
    got = {(-1 if r["doc_id"] is None else r["doc_id"], r["start"]): r["ids"] for r in out}
    for i, t in want:
        ids = library.encode(t, add_special_tokens=False).ids + [1]
        assert got[i, start] == ids, (i, t)
        start += len(ids)
    crc = token_files.read_token_files(files, digest=token_files.ids_crc32).collect()
    assert {(r["start"], r["digest"]) for r in crc} == {(r["start"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in out}
    assert not [f for f in os.listdir(tmp_path / "t") if f.startswith("_part")]
    none = token_files.write_token_files(df.limit(0), f"file://{tmp_path}/e", path, 49408, 1)
    assert token_files.read_token_files(none).count() == 0


def test_span_cache_begins_anew():
    cache = spans.SpanCache(lambda some: [[len(s)] for s in some], keep_space=False, limit=3)
    for text in (b"a bb ccc dddd", b"a  eeeee", b"", b" ff "):
        ids, offsets = cache.encode([text, text])
        assert ids[: offsets[1]].tolist() == [len(w) for w in text.split()]
    rng, calls = random.Random(14), []
    cache = spans.SpanCache(lambda some: calls.extend(some) or [list(s.encode()) for s in some], keep_space=False, limit=40)
    for _ in range(60):
        words = ["often%d" % rng.randrange(9) for _ in range(9)] + ["rare%d" % rng.randrange(10**6) for _ in range(9)]
        ids, _ = cache.encode([" ".join(words).encode()])
        assert bytes(ids.tolist()) == "".join(words).encode()
    assert sum(c.startswith("often") for c in calls) < 30 and len(cache._hashes) < 80  # most of what comes again is kept
    assert list(ragged.chunks_by_size([5, 5, 20, 1], 10)) == [(0, 2), (2, 3), (3, 4)]


def test_spans_that_share_a_hash(monkeypatch):
    real = spans.hash_spans
    monkeypatch.setattr(spans, "hash_spans", lambda *a: real(*a) % np.uint64(5))
    for keep_space in (False, True):
        cache = spans.SpanCache(lambda some: [list(s.encode()) for s in some], keep_space=keep_space)
        for text in (b"ab", b"ab cd", b"cd", b"a b c d e f g h i j k l m n", b"zz ab", b""):
            ids, offsets = cache.encode([text, b"x " + text])
            want = text if keep_space else b"".join(text.split())
            assert bytes(ids[: offsets[1]].tolist()) == want
            assert bytes(ids[offsets[1] :].tolist()) == (b"x " + text if keep_space else b"x" + want)


def test_hashes_by_block(monkeypatch):
    data = np.frombuffer(b" ".join(b"w%d" % (i % 700) for i in range(5000)) + b" " + b"L" * 5000 + b" w1", np.uint8)
    word = ~spans.IS_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    whole = spans.hash_spans(data, edges[0::2], edges[1::2])
    monkeypatch.setattr(spans, "BLOCK", 1 << 10)
    spans._powers.cache_clear()
    assert (spans.hash_spans(data, edges[0::2], edges[1::2]) == whole).all()
    spans._powers.cache_clear()
    known = {}
    for a, b, h in zip(edges[0::2], edges[1::2], whole.tolist(), strict=True):
        assert known.setdefault(data[a:b].tobytes(), h) == h
    assert len(set(known.values())) == len(known) == 701


SMALL = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.fit(language_id.training_rows(docs, language_id.not_held_out()))
    out = docs.filter(~language_id.not_held_out()).select("lang", language_id.predict(F.col("text"), model).alias("p")).collect()
    right = np.mean([r["lang"] == r["p"]["lang"] for r in out])
    assert len(out) > 100 and right > 0.97
    assert np.mean([r["p"]["rejected"] for r in out]) < 0.02


def test_sgd_step_is_the_gradient():
    rng = np.random.default_rng(5)
    embed, linear = rng.normal(size=(6, 3)), rng.normal(size=(3, 4))
    ids, weights, y = np.array([0, 2, 5]), np.array([0.5, 0.3, 0.2]), 1

    def loss(e, m):
        mean = [sum(w * e[i][d] for i, w in zip(ids, weights, strict=True)) for d in range(3)]
        z = [sum(mean[d] * m[d][k] for d in range(3)) for k in range(4)]
        return math.log(sum(math.exp(x) for x in z)) - z[y]

    def slope(which, at):
        out = []
        for h in (1e-5, -1e-5):
            pair = [embed.copy(), linear.copy()]
            pair[which][at] += h
            out.append(loss(*pair))
        return (out[0] - out[1]) / 2e-5

    moved = [embed.copy(), linear.copy()]
    language_id.sgd_step(*moved, ids, weights, y, 0.01)
    for which, (old, rate) in enumerate(((embed, 0.01), (linear, 0.0005))):
        for at in np.ndindex(old.shape):
            assert abs((old[at] - moved[which][at]) / rate - slope(which, at)) < 1e-4


def test_language_probabilities_by_hand():
    rng = np.random.default_rng(6)
    model = language_id.LanguageModel(["a", "b", "c"], rng.normal(size=(language_id.BUCKETS, 3)), 0.7, 0.0)
    texts = [b"Hello w\xc3\xb6rld", b"a", b"xy " * 50]
    got = model.probabilities(texts)
    for text, p in zip(texts, got, strict=True):
        assert np.allclose(p, model.probabilities([text])[0])  # whatever stands beside it
        buckets, starts, ends = language_id.ngram_buckets([text])
        rows = buckets[starts[0] : ends[0]]
        assert len(rows) == len(text) + 1
        z = [sum(model.logits[b][k] for row in rows for b in row) / rows.size / 0.7 for k in range(3)]
        e = [math.exp(x - max(z)) for x in z]
        assert np.allclose(p, np.array(e) / sum(e))
    temperature, threshold = language_id.calibrate(np.array([[5.0, 0], [4, 0], [0, 6]]), np.array([0, 0, 1]), np.array([[1.0, 0], [0, 1]]))
    assert 0.002 < temperature < 5 and 0.5 < threshold < 0.51  # three texts do not show a quantile
    many = np.tile(np.array([[5.0, 0], [0.3, 0]]), (1000, 1))
    assert 0.5 < language_id.calibrate(many, np.zeros(2000, int), many[:, ::-1])[1] < 0.9


def test_language_training_rows(spark):
    rows = [(1, "x" * 9000, "en"), (2, "b " * 3, "fr"), (2, "b " * 3, "fr"), (2, "b " * 3, "de"), (3, None, "en"), (4, "text", None), (5, "12", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("h", F.lit(1))
    got = language_id.training_rows(df, F.lit(True))
    assert sorted((len(t), lang) for t, lang in got) == [(6, "de"), (6, "fr"), (language_id.TRAIN_CHARS, "en")]


def test_language_odd_rows(spark):
    model = language_id.fit([("the cat and the dog " * 3, "en"), ("le chat et la souris " * 3, "fr")] * 10)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD + ["12 34 !", "the dog " * 40])], "doc_id long, text string, lang string")
    out = df.select("text", "lang", language_id.predict(F.col("text"), model).alias("p")).collect()
    for r in out:
        if any(c.isalpha() for c in r["text"] or ""):
            assert r["p"]["lang"] in ("en", "fr") and 0 < r["p"]["score"] <= 1
        else:
            assert tuple(r["p"]) == ("und", 0.0, True)
    assert language_id.fit([]) is None
    none = df.select(language_id.predict(F.col("text"), None).alias("p")).collect()
    assert {r["p"]["lang"] for r in none} == {"und"}
    assert language_id.training_rows(df.limit(0), F.lit(True)) == []


def test_quality_held_out(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", quality.statistics_column(F.col("text")).alias("stats"))
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality.fit(*quality.training_sample(docs, labels, language_id.not_held_out()))
    held = docs.filter(~language_id.not_held_out()).join(labels, "doc_id").select("quality", quality.score_column(F.col("stats"), model).alias("s")).collect()
    assert len(held) > 40
    assert np.mean([(r["s"] >= 0.3) == (r["quality"] == 1) for r in held]) > 0.95


def test_quality_by_hand():
    rng = np.random.default_rng(8)
    x = np.vstack((rng.normal(0, 1, (30, 3)), rng.normal(1, 2, (20, 3))))
    y = np.array([0.0] * 30 + [1.0] * 20)
    model = quality._discriminant(x, y, 0.2)
    groups = [[list(r) for r, c in zip(x, y, strict=True) if c == k] for k in (0, 1)]
    means = [[sum(r[d] for r in g) / len(g) for d in range(3)] for g in groups]
    spread = [[[sum((r[i] - m[i]) * (r[j] - m[j]) for r in g) for j in range(3)] for i in range(3)] for g, m in zip(groups, means, strict=True)]
    for row in x[::7]:
        logs = []
        for k in (0, 1):
            pooled = [[(spread[0][i][j] + spread[1][i][j]) / 48 for j in range(3)] for i in range(3)]
            cov = [[0.8 * spread[k][i][j] / (len(groups[k]) - 1) + 0.1 * (pooled[i][j] + (pooled[i][i] if i == j else 0)) for j in range(3)] for i in range(3)]
            off = np.array([row[d] - means[k][d] for d in range(3)])
            logs.append(-0.5 * off @ np.linalg.solve(np.array(cov), off) - 0.5 * math.log(np.linalg.det(np.array(cov))))
        assert abs(model.difference(row[None])[0] - (logs[1] - logs[0])) < 1e-9
    model.scale, model.shift = 0.5, -0.2
    assert abs(model.score(x[:1])[0] - 1 / (1 + math.exp(-(0.5 * model.difference(x[:1])[0] - 0.2)))) < 1e-12


def test_quality_labels(spark):
    stats = spark.createDataFrame([(i, [float(i)], "x") for i in (1, 2, 3, 4, 4)], "doc_id long, stats array<double>, y string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (2, 1), (3, None), (4, 0), (None, 1), (5, 7)], "doc_id long, quality int")
    x, y = quality.training_sample(stats, labels, F.lit(True))
    assert sorted(zip(x[:, 0].tolist(), y.tolist(), strict=True)) == [(1.0, 1.0), (4.0, 0.0)]
    assert quality.training_sample(stats, labels.limit(0), F.lit(True))[1].tolist() == []


def test_quality_odd_rows(spark):
    x = quality.statistics([(t or "").encode() for t in ODD])
    assert x.shape == (len(ODD), quality.N_FEATURES) and np.isfinite(x).all()
    one = np.vstack([quality.statistics([(t or "").encode()]) for t in ODD])
    assert np.allclose(x, one)
    assert quality.fit(np.zeros((0, 3)), np.zeros(0)).score(x).tolist() == [0.5] * len(ODD)
    rng = np.random.default_rng(1)
    y = (rng.random(200) < 0.5).astype(float)
    model = quality.fit(np.column_stack((y + rng.normal(0, 0.2, 200), np.ones(200))), y)
    s = model.score(np.array([[0.0, 1.0], [1.0, 1.0]]))
    assert s[0] < 0.1 and s[1] > 0.9
    df = spark.createDataFrame([], "doc_id long, text string").select(quality.statistics_column(F.col("text")))
    assert df.count() == 0


def _pipeline_fixture():
    rng = random.Random(11)
    words = {"en": "the of and to in that with for was thing other house water".split(), "fr": "le la les et de une dans pour que avec maison eau autre".split()}
    rows, item = [], "zebra quartz violin harbour lantern meadow cobalt thimble walnut saffron pepper"
    for i in range(60):
        lang = "en" if i % 3 else "fr"
        rows.append((i, " ".join(rng.choice(words[lang]) for _ in range(60)), lang))
    rows += [(100 + i, rows[i][1] + " ", "en") for i in range(5)]  # exact copies, longer ones
    rows += [(200 + i, rows[i + 10][1].rsplit(" ", 2)[0] + " end here", "en") for i in range(5)]  # near copies
    rows += [(300, rows[20][1] + " " + item + " " + rows[21][1], "en"), (301, "12 34", "en"), (302, None, None), (303, rows[30][1], "en"), (303, rows[30][1], "en")]
    return rows, [(1, item), (2, None)]


def test_pipeline_decodes(spark):
    import corpus_pipeline

    rows = [(i, t, "x") for i, t in enumerate(ODD)]
    out = corpus_pipeline.encode(spark, spark.createDataFrame(rows, DOCS), "").collect()
    assert {r["doc_id"]: r["decoded_sha256"] for r in out} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t, _ in rows}


def test_pipeline(spark, tmp_path, reference_bpe):
    import corpus_pipeline

    rows, items = _pipeline_fixture()
    d = f"file://{tmp_path}"
    schema = "doc_id long, text string, lang string, digest string"
    spark.createDataFrame([(*r, "x") for r in rows], schema).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = filters.keep_identified(docs)
    assert kept.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert {i for i, _, _ in rows} - {i for i, _ in left} == {301, 302}
    groups = {}
    for i, t in left:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i, t))
    left = sorted(min(g)[1:] for g in groups.values())
    names = _components([i for i, _ in left], _sets([t for _, t in left]))
    left = [(i, t) for i, t in left if names[i] == i]
    left = [(i, t) for i, t in left if "cobalt" not in t]
    out = corpus_pipeline.run(spark, d).collect()
    assert {r["doc_id"]: r["ids"] for r in out} == {i: reference_bpe.encode_ordinary(t) for i, t in left}
    assert len(out) == len(left) and all(r["n_tokens"] == len(r["ids"]) for r in out)
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, d).count() == 0
