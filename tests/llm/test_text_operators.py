"""Chat windows, secrets, exact dedup, BPE, packing: against brute force and on awkward input."""

from __future__ import annotations

import base64
import random
import re
import string
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import lower, same, sha
from tokenizers import Tokenizer

from phenomill.llm import bpe, chat_windows, exact_index, packing, queries, secret_scan

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
AWKWARD = [
    None, "", " ", "\n\n\n", "a", "A" * 5000, " " * 3000, "x" * 3 + " " * 40 + "y", "ab\x1ccd", "\x85 ü᠎", "don't I'll WE'VE",
    "日本語 テキスト 12345678", "🙂🙂 👨‍👩‍👧", "<|endoftext|> a<|endoftext|>", "́̀ é", "password = 'hunter2hunter2'", "\x00\x01",
    "tab\tand\r\nbreaks ", "İıſK ÀÉ", "a" * 999 + "!" * 999,
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, "x", 0.5) for i, t in enumerate(AWKWARD)] + [(None, "no id", "y", 1.0), (3, "\n\n\n", "again", 2.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, n_tokens double")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# exact dedup


def expected_groups(rows):
    groups: dict = {}
    for key, text in rows:
        groups.setdefault(lower(text or ""), []).append(key)
    out = []
    for text, keys in groups.items():
        stays = max((k for k in keys if k is not None), default=None)
        out += [(k, stays, len(keys), k is not None and k == stays, sha(text)) for k in keys]
    return sorted(out, key=str)


def test_exact_groups(spark, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()] + [(100 + i, "Hot Text") for i in range(500)] + [(700, "hot tExT"), (701, "HÖT"), (702, "höt")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    mine = sorted((tuple(r) for r in exact_index.exact_groups(df).collect()), key=str)
    assert mine == expected_groups(rows)
    kept = exact_index.drop_copies(df)
    assert kept.columns == ["doc_id", "text"]
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in mine if r[3]} | {None}


def test_exact_empty(spark):
    assert exact_index.exact_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_cuckoo_index_grows_and_deletes():
    index, rng = exact_index.CuckooIndex(buckets=4), random.Random(5)
    keys = [rng.randbytes(32) for _ in range(5000)]
    for i, key in enumerate(keys):
        index.add(key, i, 1)
        index.add(key, i + 10, 2)
    assert index.grown > 3 and all(index.get(k) == [i + 10, 3] for i, k in enumerate(keys))
    assert all(index.delete(k) for k in keys[::2]) and not index.delete(keys[0])
    assert [index.get(k) is not None for k in keys] == [i % 2 == 1 for i in range(5000)]
    assert sum(index.may_contain(rng.randbytes(32)) for _ in range(2000)) < 40


def test_update_index(spark, frame):
    docs = frame("doc_id long, text string", *[(i, f"t{i % 5}") for i in range(20)])
    rows = exact_index.digests(docs)
    index = exact_index.build_index(rows)
    more = exact_index.digests(frame("doc_id long, text string", (50, "T0"), (51, "new")))
    gone = exact_index.digests(frame("doc_id long, text string", (0, "t1"))).select("digest")
    state = {r.keep_id: r.group_size for r in exact_index.update_index(index, more, gone).collect()}
    assert state == {50: 5, 51: 1, 17: 4, 18: 4, 19: 4}


# secrets


def expected_spans(text):
    found = []
    for kind, (pattern, least, flags) in enumerate((
        (r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, re.I | re.A),
        (r"AKIA[A-Z0-9]+", 20, 0),
        (r"[0-9a-f]+", 24, 0),
    )):
        for m in re.finditer(pattern, text, flags):
            if len(m[2] if kind == 0 else m[0]) >= least:
                found.append((m.start(), kind, m.end()))
    return ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))


def test_secret_spans(spark, documents):
    mine = secret_scan.digest_columns(secret_scan.scan(documents, RANKS)).collect()
    same([(r.doc_id, r.base_sha256) for r in mine], {r.doc_id: (sha(expected_spans(r.text or "")),) for r in documents.collect()})
    assert all(sum(r[1:4]) + r.n_random == len([s for s in r.spans.split(",") if s]) for r in mine)


def test_secret_cases(frame):
    token = "Zk3Qv9TtXw71LmNpR4sYbC2d"
    uuid, digest = "123e4567-e89b-12d3-a456-426614174000", "d41d8cd98f00b204e9800998ecf8427e"
    cases = {
        1: f"é {token}.", 2: f"id {uuid}", 3: f"md5 {digest}", 4: "this_is_a_long_identifier_name ok", 5: None, 6: "", 7: "token: short",
        8: "Api_Key = 'abcdefgh'", 9: "AKIA" + "A" * 15, 10: "AKIA" + "A" * 16, 11: f"secret={token}", 12: "ſecret=abcdefgh",
    }
    rows = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.scan(frame("doc_id long, text string", *cases.items()), RANKS).collect()}
    assert rows[1] == [("random", 2, 26)] and rows[3] == [("hex", 4, 36)]
    assert all(rows[k] == [] for k in (2, 4, 5, 6, 7, 9, 12))
    assert rows[8] == [("assign", 0, 19)] and rows[10] == [("access", 0, 20)] and rows[11] == [("assign", 0, 31)]


def random_strings(letters: str, length: int, n: int = 300) -> list[str]:
    rng = random.Random(length)
    return ["".join(rng.choices(letters, k=length)) for _ in range(n)]


def covered(text: str, secret: str) -> bool:
    at = text.index(secret)
    return any(s <= at and at + len(secret) <= e for s, _, e in secret_scan.spans_of(text, secret_scan.MAX_RATIO, secret_scan.encoding(RANKS)))


@pytest.mark.parametrize("length", [20, 24, 32, 40])
def test_random_after_words(length):
    for frame_ in ("access_credentials_for_production_database={}", "https_callback/oauth/authorize/{}", "value-of-the-session-cookie-{}-for-the-user"):
        texts = random_strings(string.ascii_letters + string.digits, length)
        assert sum(covered(f"see {frame_.format(s)} here", s) for s in texts) >= 0.99 * len(texts)
    for s in random_strings(string.ascii_letters + string.digits, 36, 50):
        s = f"{s[:12]}/{s[12:20]}+{s[20:]}"  # no piece has 20 characters
        assert covered(f"access_credentials_for_production_database={s}", s)


def test_random_of_one_case_and_in_groups():
    for letters in (string.ascii_lowercase, string.ascii_uppercase):
        texts = random_strings(letters, 32)
        for form in ("{}", "access_credentials_for_production_database={}"):
            assert sum(covered(form.format(s), s) for s in texts) >= 0.97 * len(texts)
    assert covered("key QWZXK-82719-PLKVQ-93821-XJQZW", "QWZXK-82719-PLKVQ-93821-XJQZW")
    for text in ("2024-01-15_10-30-00_000000", "12345678901234567890123", "-" * 40, "=_" * 20, "123E4567-E89B-12D3-A456-426614174000"):
        assert not covered(text, text)


def test_readable_runs_stay():
    digest = "9E107D9D372BB6826BD81D3542A419D6"
    for text in ("access_credentials_for_production_database", "https_callback/oauth/authorize/user_settings", f"checksum_of_the_archive_in_the_production_database_server={digest}",
                 "identifier_of_the_request/123e4567-e89b-12d3-a456-426614174000/details"):
        assert secret_scan.spans_of(text, secret_scan.MAX_RATIO, secret_scan.encoding(RANKS)) == []


def test_redact_keeps_columns(awkward):
    out = secret_scan.redact(awkward, RANKS)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    texts = [r.text for r in out.collect()]
    assert "[secret]'" in texts and None in texts


# BPE


def test_bpe_round_trip(spark, awkward, documents):
    encoding = reference()
    docs = documents.select("doc_id", "text").unionByName(awkward.where("doc_id < 100").selectExpr("doc_id + 1000000 + length(spans) * 100 AS doc_id", "text"))
    expected = {}
    for r in docs.collect():
        ids = encoding.encode_ordinary(r.text or "")
        expected[r.doc_id] = (len(ids), sha(" ".join(map(str, ids))), sha(r.text or ""))
    same(bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect(), expected)
    ids = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    back = {r.doc_id: bytes(r.data) for r in bpe.decode(ids, RANKS, public_tokenizers.PATTERN).collect()}
    assert back == {r.doc_id: (r.text or "").encode() for r in docs.collect()}


def test_bpe_random_strings():
    codec, encoding, rng = bpe.codec(RANKS, public_tokenizers.PATTERN), reference(), random.Random(1)
    for _ in range(400):
        text = "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x20, 0x500), rng.randrange(0x3000, 0x3100), 32, 10])) for _ in range(rng.randrange(60)))
        assert codec.encode(text) == encoding.encode_ordinary(text)
    assert codec.encode("ab" * 20000) == encoding.encode_ordinary("ab" * 20000)


def test_perfect_hash():
    keys = [f"key{i}".encode() for i in range(3000)]
    table = bpe.PerfectHash(keys)
    assert table.find(keys) == list(range(3000)) and sum(len(t) for t in table.taken) < 20000
    assert table.find([b"stranger", b""]) == [-1, -1]


# packing


def test_packing(spark, awkward, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = documents.select("doc_id", "text").unionByName(awkward.where("doc_id < 100 AND spans = 'x'").selectExpr("doc_id + 1000000 AS doc_id", "text"))
    rows = packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN).collect()
    pieces: dict = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        own = sorted(pieces.pop(r.doc_id), key=lambda p: p.piece)
        assert [p.piece for p in own] == list(range(len(own))) and sum(p.length for p in own) == len(ids)
        assert all(p.length == 2048 for p in own[1:])
        for p in own:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], dtype="<u4").tobytes())
    assert not pieces
    bins: dict = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-sum(r.length for r in rows) // 2048) + 2


def test_best_fit_limits():
    lengths = np.array(random.Random(3).choices(range(1, 100), k=600))
    for score in ("norm", "dot"):
        bins, offsets = packing.best_fit(lengths, (256.0, 6.0, 12000.0), score=score)
        for b in np.unique(bins):
            own = np.flatnonzero(bins == b)
            assert len(own) <= 6 and lengths[own].sum() <= 256 and (lengths[own] ** 2).sum() <= 12000
            order = own[np.argsort(offsets[own])]
            assert (offsets[order] == np.cumsum(lengths[order]) - lengths[order]).all()
    with pytest.raises(ValueError):
        packing.best_fit(np.array([300]), (256.0, 6.0, 1e9))


def test_sequences(spark, frame):
    docs = frame("doc_id long, text string", *[(i, "some words " * (i * 40)) for i in range(12)])
    path = public_tokenizers.path("byte_bpe_50k.json")
    placed = packing.packed_documents(docs, path, public_tokenizers.PATTERN)
    for r in packing.sequences(docs, placed, path, public_tokenizers.PATTERN).collect():
        assert len(r.ids) == sum(r.lengths) <= 2048


# chat


def expected_chat(rows):
    turns: dict = {}
    for conv, turn, role, text in rows:
        turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, own in turns.items():
        own.sort()
        target = "".join(t for *_, role, t in own if role == "assistant")
        out[conv] = (len(own), sha("".join(f"{r}\n{t}\n" for *_, r, t in own)), len(target), sha(target))
    return out


def test_chat_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    probe = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", probe), (-1, 1, "assistant", probe)]
    mine = queries.op2_chat_windows(spark, FOLDER)
    same(mine.drop("formatted_chars").collect(), expected_chat(rows))
    assert all(r.formatted_chars > 0 for r in mine.collect())


def test_chat_windows(spark, frame):
    rows = [(7, 0, "system", "be brief")]
    rows += [(7, i, ("user", "assistant")[i % 2], f"{i} " + "word " * (i % 9 * 12) + "<|end|>\n\\.") for i in range(1, 60)]
    rows += [(8, None, None, None), (8, 1, "assistant", "x " * 900), (8, 1, "assistant", "x " * 900), (9, 1, "<|turn|>", "<<|<s>|>\\")]
    df = frame("conv_id long, turn long, role string, text string", *rows).selectExpr("*", "1 AS window", "2 AS n_tokens")
    windows = chat_windows.windows(df, RANKS, public_tokenizers.PATTERN, budget=200, history=120)
    found = windows.collect()
    same(chat_windows.read_back(windows).drop("formatted_chars").collect(), expected_chat(rows))
    long = sorted((w for w in found if w.conv_id == 7), key=lambda w: w.window)
    assert len(long) > 5 and all(chat_windows.parse(w.formatted)[0][:2] == ("system", "be brief") for w in long)
    assert any(w.repeated > 1 for w in long) and all((w.n_tokens <= 200) != w.over for w in found)
    assert any(w.over for w in found if w.conv_id == 8)
    counted = reference()
    for w in found:
        said = [chat_windows.render(role, text)[0] for role, text, *_ in chat_windows.parse(w.formatted)]
        assert "".join(said) == w.formatted and w.n_tokens == sum(len(counted.encode_ordinary(t)) for t in said)
    turns = [r for r in chat_windows.turn_rows(windows).collect() if r.conv_id == 7]
    assert sorted(r.turn_index for r in turns) == list(range(60)) and all(r.target == (r.role == "assistant") for r in turns)


def test_chat_tokens_of_long_white_space():
    count = chat_windows.token_counter(RANKS, public_tokenizers.PATTERN)
    spaces = " " * 1_000_000
    assert count(spaces + "x") == len(bpe.codec(RANKS, public_tokenizers.PATTERN).encode(spaces + "x"))
    assert count("a  b\n\n c's") == len(reference().encode_ordinary("a  b\n\n c's"))


def test_chat_escape():
    for text in ("\\", "\\.", "<<|>", "<|\\.|>", "</s><s>[INST][/INST]<<SYS>><</SYS>>", ""):
        escaped = chat_windows.escape(text)
        assert chat_windows.unescape(escaped) == text and not chat_windows.CONTROL.search(escaped)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert secret_scan.scan(docs, RANKS).count() == bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).count() == 0
    assert packing.packed_documents(docs, path, public_tokenizers.PATTERN).count() == 0
    chats = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_windows.read_back(chat_windows.windows(chats, RANKS, public_tokenizers.PATTERN)).count() == 0
