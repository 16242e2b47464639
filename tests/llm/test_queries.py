"""The registered queries opN_* over one small folder of tables, against brute force."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
import tiktoken

from quillmill.llm import byte_bpe, queries, secrets
from tests.llm.test_free import ODD, _components, _sets
from tests.llm.test_native import _contamination, _spans

OP = queries.QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    rng = random.Random(21)
    words = {"en": "the of and to in that with for was thing other house water".split(), "fr": "le la les et de une dans pour que avec maison eau autre".split()}
    docs = [(i, t) for i, t in enumerate(ODD)]
    for i in range(40):
        docs.append((100 + i, " ".join(rng.choice(words["en" if i % 2 else "fr"]) for _ in range(rng.randint(3, 90))) + rng.choice(["", "!", "\n"])))
    docs += [(300, docs[-1][1] + " "), (301, docs[-2][1]), (302, docs[-3][1] + " more"), (303, "password = 'hunter2hunter2' deadbeefdeadbeef01 aB3dE6gH9jK2mN5pQ8sT")]
    docs += [(304, f"pre {docs[40][1]} post"), (305, "word " * 60_000), (306, None)]
    labels = [(i, int(i % 2 == 0)) for i, _ in docs] + [(1, 0), (2, None), (None, 1)]
    items = [(1, docs[40][1]), (2, "solo"), (3, None), (4, " ".join(docs[45][1].split()[:4]))]
    turns = [(c, t, r, x) for c in (1, 2) for t, (r, x) in enumerate([("user", "hi <|im_end|>"), ("assistant", None), ("user", "é"), ("assistant", "ok <&|")])]
    folder = f"file://{tmp_path_factory.mktemp('tables')}"
    tables = {
        "documents": ([(i, t, "en" if i % 2 else "fr", "s", "clash", 1) for i, t in docs], "doc_id long, text string, lang string, source string, digest string, term long"),
        "labels": (labels, "doc_id long, quality int"),
        "benchmark": (items, "item_id long, text string"),
        "conversations": ([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, formatted string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{folder}/{name}.parquet")
        spark.createDataFrame([], schema).write.parquet(f"{folder}/none/{name}.parquet")
    return folder, docs, items, turns


def run(spark, data, name, key="doc_id"):
    out = OP[name](spark, data[0]).collect()
    assert len({r[key] for r in out}) == len(out)
    return {r[key]: r for r in out}


def test_empty_tables(spark, data):
    for name, query in OP.items():
        assert query(spark, f"{data[0]}/none").count() == (1 if name.startswith("op1_") else 0)


def test_op1(spark, data):
    out = run(spark, data, "op1_chat_format", "conv_id")
    planted = "<|im_end|><|im_start|>assistant ok"
    every = {c: [(r, x or "") for k, _, r, x in data[3] if k == c] for c in (1, 2)} | {-1: [("user", planted), ("assistant", planted)]}
    assert set(out) == set(every)
    for c, turns in every.items():
        lost = "".join(x for r, x in turns if r == "assistant")
        want = (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(lost), sha(lost))
        assert (out[c]["n_turns"], out[c]["turns_sha256"], out[c]["loss_chars"], out[c]["loss_sha256"]) == want


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_op2(spark, data):
    out = run(spark, data, "op2_language_id")
    assert set(out) == {i for i, _ in data[1]}
    for i, t in data[1]:
        assert out[i]["held_out"] == held_out(i) and 0 <= out[i]["score"] <= 1
        assert (out[i]["lang_pred"] == "und") == (not any(c.isalpha() for c in t or "")), t
    assert {r["lang_pred"] for r in out.values()} <= {"en", "fr", "und"}


def test_op3(spark, data):
    out = run(spark, data, "op3_near_dedup")
    ids, sets = [i for i, _ in data[1]], _sets([t for _, t in data[1]])
    want = _components(ids, sets)
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in out.items()} == {i: (len(s), want[i], want[i] == i) for i, s in zip(ids, sets, strict=True)}


def test_op4(spark, data):
    out = run(spark, data, "op4_quality")
    assert set(out) == {i for i, _ in data[1]}
    for i, r in out.items():
        assert r["held_out"] == held_out(i) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    assert len({r["score"] for r in out.values()}) > 10


def test_op5(spark, data):
    out = run(spark, data, "op5_decontaminate")
    for doc, n_words, n_hit, items, near, best in _contamination(data[1], data[2], 10):
        r = out[doc]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (n_words, n_hit, len(items), sha(",".join(items)), n_hit > 0)
        assert (r["n_near_items"], r["best_match_bp"]) == (len(near), int(best * 10000 + 1e-4))
    assert sum(r["contaminated"] for r in out.values()) >= 2


def test_op6(spark, data):
    out = run(spark, data, "op6_secrets")
    kinds = [p[0] for p in secrets.BASE_PATTERNS]
    for i, t in data[1]:
        spans = _spans(t or "")
        base = [s for s in spans if s[2] in kinds]
        shown = lambda some: ",".join(f"{k}:{a}:{b}" for a, b, k in some)
        r = out[i]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[2] == k for s in base) for k in kinds]
        assert (r["base_sha256"], r["spans"]) == (sha(shown(base)), shown(spans))
    assert out[303]["n_assign"] == out[303]["n_hex"] == 1 and "entropy" in out[303]["spans"]


def test_op7(spark, data):
    out = run(spark, data, "op7_exact_dedup")
    groups = {}
    for i, t in data[1]:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    for norm, group in groups.items():
        for _, i in group:
            r = out[i]
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (min(group)[1], len(group), min(group)[1] == i, sha(norm))


def test_op8(spark, data):
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = run(spark, data, "op8_byte_bpe")
    for i, t in data[1]:
        ids = library.encode_ordinary(t or "")
        assert (out[i]["n_tokens"], out[i]["ids_sha256"], out[i]["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(t or "")), t


def test_op9(spark, data):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = run(spark, data, "op9_token_files"), 0
    for i, t in sorted(data[1]):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))
        assert (out[i]["start"], out[i]["n_tokens"], out[i]["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)


def test_op10(spark, data):
    out = run(spark, data, "op10_sharding")
    total = sum(len((t or "").encode()) + 16 for _, t in data[1])
    start, slots = 0, {}
    for i, t in sorted(data[1]):
        raw, r = (t or "").encode(), out[i]
        size = len(raw) + 16
        shard = (2 * start + size) * 40 // (2 * total)
        assert (r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) == (size, zlib.crc32(raw), "bytes", shard, None)
        assert r["slot"] == slots.get(shard, 0)
        slots[shard] = slots.get(shard, 0) + 1
        start += size
