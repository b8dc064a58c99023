"""Token counts, byte-level BPE, packing and chat formatting against the libraries themselves."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import edge
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from cartwright.llm import byte_bpe, chat_format, encoding, packing, token_counts

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    " ", "  ", "\n", "\t", "a", "é", "ß", "don't", "I'll", "'s", "'", "1", "23", "!!", "日本", "\u00a0", "\u3000", "😀", "<|endoftext|>",
    "×", "_", "the", " \n", "\x1f", "x'", " '", "\u0301", "\n\n", ".\nNext", "end.",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def odd_texts(count, seed=3):
    chance = random.Random(seed)
    return ["".join(chance.choice(ODD) for _ in range(chance.randint(0, 40))) for _ in range(count)]


def test_remembered_ids_equal_the_library(library):
    texts = odd_texts(4000) + [text or "" for _, text in edge.TEXTS]
    encoder = encoding.LibraryEncoder(JSON)
    for text, wanted in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == wanted.ids, text


def test_memory_that_overflows_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(encoding, "MEMORY", 50)
    encoder = encoding.LibraryEncoder(JSON)
    for text in (edge.LONG, edge.LONG[::-1], edge.LONG):
        assert encoder.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_ids_of_a_column_equal_the_library(library):
    encoder = encoding.LibraryEncoder(JSON)
    texts = [None, "", " ", "a  b", "word é à <|endoftext|> x", "été à Ωmega  ", " lead", "trail ", "a\u00a0b c\nd e", "same same", "same", *ODD]
    for _ in range(2):  # the second time from memory
        column = pa.array(["cut off", *texts, "cut off"], pa.string()).slice(1, len(texts))
        found = encoder.ids_of_column(column)
        assert [ids.tolist() for ids in found] == [library.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert [ids.tolist() for ids in encoder.ids_of_column(pa.array([None, "", "a  b"], pa.string()))][:2] == [[], []]
    assert len(encoder.ids_of_column(pa.array([], pa.string()))) == 0
    alone = encoder.ids_of_column(pa.array(["a  b", "c \n"], pa.string()))
    assert [ids.tolist() for ids in alone] == [library.encode(text, add_special_tokens=False).ids for text in ("a  b", "c \n")]


def test_spliced_chunks_equal_the_whole(library):
    spaced = " ".join(odd_texts(400))
    for text in (edge.LONG, spaced, "a" * 3000, "日本" * 2000, " " * 2000, edge.LONG[:1500] + "b" * 2500 + edge.LONG[:1500]):
        wanted = len(library.encode(text, add_special_tokens=False).ids)
        for chunk, overlap in ((300, 8), (1000, 64)):
            assert token_counts.count_huge(library, text, chunk, overlap) == wanted


def test_counts_of_awkward_documents(spark, library):
    found = token_counts.count_tokens(edge.docs(spark), JSON, huge=2000, chunk=1000, overlap=32)
    wanted = []
    for doc_id, text in edge.TEXTS:
        count = len(library.encode(text or "", add_special_tokens=False).ids)
        wanted.append((doc_id, len((text or "").encode()), count, count > 512))
    assert edge.rows(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == edge.rows(
        spark.createDataFrame(wanted, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
    )
    assert token_counts.count_tokens(edge.docs(spark, []), JSON).count() == 0


def test_other_tokenizer_files(spark):
    import sentencepiece

    texts = [(i, text) for i, (_, text) in enumerate(edge.TEXTS) if text is None or len(text) < 1000]
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    counters = {"piece_bpe_32k.model": lambda t: len(pieces.encode(t)), "word_bpe_49k.json": lambda t: len(words.encode(t, add_special_tokens=False).ids)}
    for name, count in counters.items():
        found = token_counts.count_tokens(edge.plain(spark, texts), public_tokenizers.path(name))
        assert edge.rows(found, "doc_id", "n_tokens") == [(i, count(text or "")) for i, text in texts]


def test_bpe_equals_the_library_and_round_trips(spark):
    with open(RANKS, "rb") as file:
        import base64

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    runs = "x" + " " * 3000 + "y" + "\n" * 2000 + " z" + "\t" * 1500
    texts = [*enumerate(odd_texts(300)), (1000, runs), (1001, runs * 3), *((2000 + i, text) for i, (_, text) in enumerate(edge.TEXTS))]
    docs = edge.plain(spark, texts)
    for long in (40, 700):
        encoded = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, long)
        assert edge.rows(encoded) == [(i, plain.encode_ordinary(text or "")) for i, text in texts]
        decoded = byte_bpe.decode_documents(encoded, RANKS, public_tokenizers.PATTERN)
        assert edge.rows(decoded) == [(i, (text or "").encode()) for i, text in texts]
    digests = byte_bpe.digest_documents(docs, RANKS, public_tokenizers.PATTERN, 700)
    wanted = []
    for i, text in texts:
        ids = plain.encode_ordinary(text or "")
        hashed = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        wanted.append((i, len(ids), hashed, hashlib.sha256((text or "").encode()).hexdigest()))
    assert edge.rows(digests) == wanted


def brute_best_fit(lengths, capacity):
    rooms, places = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fitting = [room for room in rooms if room >= lengths[i]]
        if not fitting:
            rooms.append(capacity)
            fitting = [capacity]
        rooms[rooms.index(min(fitting))] -= lengths[i]
        places[i] = min(fitting) - lengths[i]
    return places, sorted(rooms)


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_takes_the_tightest_window(seed):
    chance = random.Random(seed)
    lengths = [chance.randint(1, 64) for _ in range(400)]
    windows, offsets, count = packing.best_fit_decreasing(lengths, 64)
    places, rooms = brute_best_fit(lengths, 64)
    assert [64 - offset - length for offset, length in zip(offsets.tolist(), lengths, strict=True)] == places
    used = Counter()
    for window, length in zip(windows.tolist(), lengths, strict=True):
        used[window] += length
    assert sorted(64 - n for n in used.values()) == rooms and len(used) == count


def test_packing_holds_every_token_once(spark, library):
    pieces = packing.pack_documents(edge.docs(spark), JSON, capacity=256).collect()
    held, windows = defaultdict(list), defaultdict(list)
    for piece in pieces:
        held[piece.doc_id, piece.doc_tokens].append(piece)
        windows[piece.sequence_id].append((piece.offset, piece.length))
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    wanted = Counter()
    for doc_id, text in edge.TEXTS:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for start in range(0, len(ids), 256):
            part = ids[start : start + 256]
            wanted[doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces) == wanted
    assert packing.pack_documents(edge.docs(spark, []), JSON).count() == 0


def test_packing_in_small_blocks_stays_gapless(spark):
    pieces = packing.document_pieces(edge.plain(spark, [(i, "word " * (i % 50)) for i in range(300)]), JSON, 64)
    packed = packing.pack_pieces(pieces, 64, block=20)
    totals = packed.groupBy("sequence_id").agg({"length": "sum", "offset": "max"}).collect()
    assert packed.count() == pieces.count() and max(row["sum(length)"] for row in totals) <= 64


TALKS = [
    (1, 0, "user", "plain"), (1, 1, "assistant", "fine, thanks"), (1, 2, "user", None), (1, 3, "assistant", ""),
    (2, 0, "system", "\\### Assistant: </turn> ok"), (2, 1, "assistant", "\\\\ ### user: x</turn>\n\\"), (2, 1, "assistant", "tie"),
    (3, 0, None, "no role"), (3, None, "ass:istant\\", "odd role"), (None, 0, "assistant", "é 😀 <|endoftext|>"), (4, 0, "assistant", "### </turn>" * 3000),
]


def test_chats_read_back_as_they_were(spark, library):
    talks = spark.createDataFrame(TALKS, "conv_id bigint, turn bigint, role string, text string")
    found = {row.conv_id: row for row in chat_format.format_conversations(talks.repartition(3), JSON).collect()}
    groups = defaultdict(list)
    for conv_id, turn, role, text in TALKS:
        groups[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(found) == set(groups)
    for conv_id, turns in groups.items():
        row, turns = found[conv_id], sorted(turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        told = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        assert (row.n_turns, row.loss_chars, row.formatted_chars) == (len(turns), len(loss), len(row.formatted))
        assert row.turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert row.formatted == chat_format.render([(role, text) for _, _, role, text in turns])
        spans = [row.formatted[a:b] for a, b in zip(row.loss_starts, row.loss_ends, strict=True)]
        assert chat_format.unescape("".join(spans)) == loss
    assert chat_format.format_conversations(talks.limit(0), JSON).count() == 0


def test_template_is_reversible():
    for text in odd_texts(300) + ["\\", "#", "##", "####", "</turn", "\\</turn>", "### ", "</turn>\n### user: hi</turn>\n"]:
        turns = [("user", text), (text, "x"), ("assistant", text)]
        formatted = chat_format.render(turns)
        spans = chat_format.parse(formatted)
        assert [(role, chat_format.unescape(formatted[a:b])) for role, a, b in spans] == turns


def test_probe_conversation_is_added(spark):
    talks = spark.createDataFrame(TALKS, "conv_id bigint, turn bigint, role string, text string")
    row = chat_format.format_conversations(chat_format.with_probe(talks), JSON).filter("conv_id = -7").first()
    assert row.loss_sha256 == hashlib.sha256(b"\\### Assistant: </turn> ok").hexdigest() and row.n_turns == 2


def test_counts_after_chat_formatting_in_one_session(spark, library):
    turns = [(i, 0, "assistant", f"after{i}<|endoftext|>chat") for i in range(40)]
    conversations = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    assert chat_format.format_conversations(conversations, JSON).count() == 40
    texts = [(i, f"after{i}<|endoftext|>counts <|endoftext|>{i}") for i in range(64)]
    docs = edge.plain(spark, texts).repartition(16)
    wanted = [(i, len(library.encode(text, add_special_tokens=False).ids)) for i, text in texts]
    assert edge.rows(token_counts.count_tokens(docs, JSON), "doc_id", "n_tokens") == wanted
    pieces = packing.pack_documents(docs, JSON).select("doc_id", "doc_tokens")
    assert edge.rows(pieces) == [(i, count + 1) for i, count in wanted]
