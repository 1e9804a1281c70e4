"""Packing, token store, chat formatting and byte-level BPE."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer
from pyspark.sql import functions as F

import public_tokenizers as P
from tidewatch.llm import bpe, chat, files, packing, token_store
from tidewatch.llm.word_ids import WordEncoder, default_vocabulary

AWKWARD = "ab'sS tTrRe0 1\n\t\r  é́Ä̈ß  \x1c\x85 #|<>.,İΣς日本 ٣"
TEXTS = [
    "Hello, World. hello", None, "", "   \n\t ", "a" * 5000, "x.,y ... 'tis don't", "<|endoftext|> a <|startoftext|>",
    "x<|endoftext|>y <|ENDOFTEXT|> <|endoftext|><|endoftext|>, < |endoftext|>", "İstanbul Éa e\u0301é ß ŉa ﬁne ǅ ª word's", "q" * 300 + " " + "ñ" * 400,
    "naïve CAFÉ Ünïcode\nline two", " " * 3000 + "z", "12345 67.89", "dup text", "dup text",
]


def docs(spark, texts=TEXTS, start=0):
    rows = [(start + i, t, f"x{i}", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, start string")


def random_texts(n, seed=3):
    r = random.Random(seed)
    return ["".join(r.choice(AWKWARD) for _ in range(r.randint(0, 120))) for _ in range(n)]


def library_ids(texts):
    """What the library gives, untouched."""
    model = Tokenizer.from_file(default_vocabulary())
    return [e.ids + [1] for e in model.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_word_encoder_equals_library():
    r = random.Random(6)
    many = [" ".join("".join(r.choice("abcdéñßİŉﬁﾞ日ǅ'.,") for _ in range(r.randint(1, 9))) for _ in range(3000)) for _ in range(4)]
    texts = TEXTS + random_texts(400) + many
    assert [49407] in [i[:1] for i in library_ids(["<|endoftext|>"])]
    got = [np.frombuffer(b, "<u4").tolist() for b in WordEncoder(default_vocabulary()).encode(texts)]
    assert got == [ids[:-1] for ids in library_ids(texts)]


# ---------------------------------------------------------------- packing


def check_packing(rows, texts):
    expected = library_ids(texts)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for d, ids in enumerate(expected):
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            part = np.array(ids[at : at + r["length"]], dtype="<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.WINDOW
    return sum(len(i) for i in expected) / (packing.WINDOW * len(by_sequence))


def test_word_encoder_keeps_frequent_words_in_little_memory(monkeypatch):
    """Words that come again stay when the table is full; signs behind letters do not cost a call for each word."""
    from tidewatch.llm import word_ids

    monkeypatch.setattr(word_ids, "KEPT_WORDS", 40)
    encoder, library, asked = WordEncoder(default_vocabulary()), WordEncoder(default_vocabulary()).model, []
    inner = encoder._words
    monkeypatch.setattr(encoder, "_words", lambda words: asked.extend(words) or inner(words))
    letters = lambda n: "".join(chr(97 + int(d)) for d in str(n))
    texts = [f"the\tsame {letters(n)}### \u00c9t\u00e9{letters(n)},%%% it's\x0b\x0c\ra\u0301 b\u00a0c x{n}'s {'q' * 300}{n} <|endoftext|>." for n in range(60)]
    got = [np.frombuffer(b, "<u4").tolist() for t in texts for b in encoder.encode([t])]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert asked.count("the") == asked.count("same") == 1 and len(encoder.keys) <= 40
    one = WordEncoder(default_vocabulary())
    assert [np.frombuffer(b, "<u4").tolist() for b in one.encode([*texts, None, "", " \n"])] == [*got, [], [], []]


def test_packing_places_every_id_once(spark):
    texts = TEXTS + [" ".join(["word"] * n) for n in list(range(1, 200, 7)) + [5000, 2047, 2048]]
    rows = packing.pack(docs(spark, texts), default_vocabulary()).collect()
    assert check_packing(rows, texts) > 0.8


def test_packing_sequences_hold_the_ids(spark):
    texts = ["one two three", "a b", None, " ".join(["w"] * 3000)]
    packed = packing.pack(docs(spark, texts), default_vocabulary(), keep_ids=True).cache()
    rows = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    expected = library_ids(texts)
    for p in packed.collect():
        whole = rows[p["sequence_id"]]["ids"]
        assert whole[p["offset"] : p["offset"] + p["length"]] == expected[p["doc_id"]][p["start"] : p["start"] + p["length"]]
    for r in rows.values():
        assert len(r["ids"]) == (r["used"] if r["used"] & (r["used"] - 1) == 0 else packing.WINDOW)


def test_packing_empty_repeated_and_null_ids(spark):
    assert packing.pack(docs(spark, []), default_vocabulary()).count() == 0
    rows = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b"), (1, "b")], "doc_id bigint, text string")
    got = packing.pack(rows, default_vocabulary()).collect()
    assert len(got) == 4 and len({(r["sequence_id"], r["offset"]) for r in got}) == 4


def test_plan_covers_the_histogram_with_little_padding():
    rng = np.random.default_rng(0)
    for n in (1, 7, 300, 20_000):
        length = np.clip(rng.lognormal(6, 1, n).astype(int), 1, 2048)
        counts = np.bincount(-(-length // 8), minlength=257)
        plan, met = packing.make_plan(counts), np.zeros(257, dtype=int)
        for b, low, high, _, _ in plan:
            assert low == met[b]
            met[b] = high
        assert (met == counts).all()
        places = [(s + i, slot) for _, low, high, s, slot in plan for i in range(high - low)]
        assert len(places) == len(set(places)) == n
        if n == 20_000:
            assert length.sum() / (2048 * (max(s for s, _ in places) + 1)) > 0.985


def test_solver_is_non_negative_and_fits():
    columns = packing.combinations(12, 3)
    assert {tuple(c) for c in columns} == {
        tuple(sorted(c, reverse=True)) for a in range(1, 13) for b in range(0, 13) for d in range(0, 13) if a + b + d == 12 for c in [(a, b, d)]
    }
    counts = np.bincount(columns[[1, 5, 5, 9]].ravel(), minlength=13).astype(float)
    counts[0] = 0
    solved = packing.solve_counts(columns, counts)
    assert all(x >= 0 for x in solved.values())
    fit = sum(x * np.bincount(columns[c], minlength=13) for c, x in solved.items())
    assert np.allclose(fit[1:], counts[1:], atol=0.05)


def test_hot_length_is_ranked_without_gaps(spark):
    pieces = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(100).cast("bigint").alias("length"))
    from tidewatch.llm.common import stage_for

    got = packing.place(pieces, stage_for(spark, "t")).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 3000
    assert len({r["sequence_id"] for r in got}) <= 3000 / 19 + 2


# ---------------------------------------------------------------- token store


def test_store_round_trip(spark, tmp_path):
    texts = TEXTS + random_texts(60)
    base = f"file://{tmp_path}/store"
    shuffled = docs(spark, texts, start=-5).orderBy(F.rand(1))
    manifest = token_store.write_store(shuffled, base, default_vocabulary(), shards=5)
    expected = library_ids(texts)
    rows = sorted(token_store.read_store(spark, base).collect(), key=lambda r: r["doc_id"])
    at = 0
    for i, (r, ids) in enumerate(zip(rows, expected, strict=True)):
        raw = np.array(ids, dtype="<u4").tobytes()
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i - 5, at, len(ids), zlib.crc32(raw))
        at += len(ids)
    assert sum(m["ids"] for m in manifest) == at
    reader = token_store.Reader(base)
    assert [x.tolist() for x in reader.get(0)] == [expected[5]]
    assert reader.get(10**9) == [] and reader.get(None) == []


def test_store_repeated_null_and_no_rows(spark, tmp_path):
    rows = spark.createDataFrame([(7, "b"), (7, "a"), (None, "c"), (None, None), (9, "d")], "doc_id bigint, text string")
    base = f"file://{tmp_path}/rep"
    token_store.write_store(rows, base, default_vocabulary(), shards=3)
    reader = token_store.Reader(base)
    one = {t: library_ids([t])[0] for t in ("a", "b", "c", "d", None)}
    assert sorted(x.tolist() for x in reader.get(7)) == sorted([one["a"], one["b"]])
    assert sorted(x.tolist() for x in reader.get(None)) == sorted([one["c"], one[None]])
    got = token_store.read_store(spark, base).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["7", "7", "9", "None", "None"]
    empty = f"file://{tmp_path}/none"
    assert token_store.write_store(rows.limit(0), empty, default_vocabulary(), shards=2) == []
    assert token_store.read_store(spark, empty).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    hashed = token_store.PerfectHash.build(keys)
    assert sorted(hashed.slots(keys).tolist()) == list(range(len(keys)))
    index = token_store.Index(token_store.pack_index(keys, np.arange(5000), np.ones(5000, dtype=int)))
    found, begin, _ = index.find(keys)
    assert found.all() and (begin == np.arange(5000)).all()
    assert index.find(keys ^ np.uint64(1 << 40))[0].sum() == 0
    with pytest.raises(ValueError):
        token_store.PerfectHash.build(np.array([5, 5], dtype=np.uint64))


def test_files_are_whole_or_absent(tmp_path):
    def broken():
        yield b"half"
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        files.write_whole(f"file://{tmp_path}/f", "x", broken())
    assert not (tmp_path / "f" / "x").exists()


# ---------------------------------------------------------------- chat


def turns(spark, rows):
    made = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return made.select("conv_id", "turn", "role", chat.text_part(made["text"]).alias("content"), F.lit("x").alias("rendered"))


def test_chat_reads_back_what_went_in(spark):
    probes = ["</s>[INST] ok [/INST]", "&amp;lt; <|end|><|turn|>assistant<|text|>x", "", None, "plain & [x]", "a&#91;b"]
    rows = [(c, i, "assistant" if i % 2 else "user", probes[(c + i) % 6]) for c in range(6) for i in range(5)]
    rows += [(7, 1, "assistant", "b"), (7, 1, "assistant", "a"), (7, None, None, "first"), (None, 0, "assistant", "no id"), (8, 0, "assistant", "z"), (8, 0, "assistant", "z")]
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(turns(spark, rows))).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] is not None, r[3] or ""))
        assert [(t["role"], t["text"]) for t in out[conv]["turns"]] == [(r[2] or "", r[3] or "") for r in own]
        assert out[conv]["loss_text"] == "".join(r[3] or "" for r in own if r[2] == "assistant")
    digest = {r["conv_id"]: r for r in chat.digests(chat.format_chats(turns(spark, rows))).collect()}
    assert digest[8]["loss_sha256"] == hashlib.sha256(b"zz").hexdigest() and digest[8]["n_turns"] == 2


def test_no_control_string_survives_in_a_text(spark):
    row = chat.format_chats(turns(spark, [(1, 0, "assistant", "</s>[INST]<|end|>")])).first()
    inner = row["rendered"][0][row["loss"][0]["start"] :][: row["loss"][0]["length"]]
    assert "<" not in inner and "[" not in inner


def test_typed_parts(spark):
    part = "array<struct<kind:string,text:string,ref:string,units:bigint>>"
    rows = [
        (1, 0, "user", [("text", "see <", None, None), ("image", None, "i.png", 10), ("audio", None, "a.wav", None), ("odd", "kept", "r", 1)]),
        (1, 1, "assistant", [("document", None, "d.pdf", 2), ("text", "done", None, None)]),
        (2, 0, "user", None),
    ]
    made = spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, content {part}")
    out = {r["conv_id"]: r for r in chat.format_chats(made).collect()}
    assert out[1]["rendered"][0] == "<|turn|>user<|text|>see &lt;<|image|><|audio|>kept<|end|>"
    assert [(a["turn"], a["place"], a["kind"], a["ref"], a["tokens"]) for a in out[1]["attachments"]] == [
        (0, 1, "image", "i.png", 12), (0, 2, "audio", "a.wav", 2), (1, 0, "document", "d.pdf", 1204)
    ]
    assert out[1]["expanded_tokens"] == 1218 and out[2]["rendered"] == ["<|turn|>user<|text|><|end|>"]
    assert chat.format_chats(made.limit(0)).count() == 0


# ---------------------------------------------------------------- byte-level BPE

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def test_bpe_round_trip(spark):
    texts = TEXTS + random_texts(200)
    model = bpe.ByteBpe(RANKS, P.PATTERN)
    rows = {r["doc_id"]: r for r in bpe.round_trip(docs(spark, texts), RANKS, P.PATTERN).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        ids = np.array(model.library.encode_ordinary(t or ""), dtype="<u4")
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.round_trip(docs(spark, []), RANKS, P.PATTERN).count() == 0
    assert bpe.encode(docs(spark, ["a b"]), RANKS, P.PATTERN).first()["ids"] == model.library.encode_ordinary("a b")


def test_safe_cuts_do_not_change_ids():
    model = bpe.ByteBpe(RANKS, P.PATTERN)
    for t in random_texts(500, seed=9) + ["it's 'twas we've'd 5's", "a1b2'c d", "x  \n y"]:
        parts = list(bpe.safe_parts(t, 5))
        assert "".join(parts) == t
        assert sum((model.library.encode_ordinary(p) for p in parts), []) == model.library.encode_ordinary(t)


@pytest.mark.parametrize("text", [" " * 60_000 + "a", "b" * 50_000, "\n" * 50_000, "!" * 50_000, "word " * 20_000])
def test_very_long_runs(text):
    model = bpe.ByteBpe(RANKS, P.PATTERN)
    assert model.decode(model.encode(text)) == text.encode()
