"""Segmentation and token files on odd characters, long stretches and bounded files, against brute force and the plain library."""

import random

import numpy as np
import pytest
from millrace.llm import sentencepiece, token_files
from tokenizers import Tokenizer

MODEL, BPE = "/opt/tokenizers/piece_bpe_32k.model", "/opt/tokenizers/byte_bpe_50k.json"
PARTS = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "a", "Bc", "word", "é", "ß", "日本", "Ω", "'s", "'", "'ll", "’s", "1", "23", "½", ".", ",", "!?", "$$$", "<|endoftext|>", "<|", "—", "\U0001f389", "́", "_", "-", "\x00", "‍", "�", "\u2581", "\ue000", "tion", "the"]


@pytest.fixture(scope="module")
def codec():
    return sentencepiece.Codec.load(MODEL)


def texts(seed, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, most))) for _ in range(n)]


def best_score(codec, text):
    """By trying every piece at every place: the score of the best segmentation; a blank is U+2581, and the text's own U+2581 is in no piece."""
    text, best = "▁" + text.replace("▁", "￿").replace(" ", "▁"), [0.0]
    for e in range(1, len(text) + 1):
        fits = [best[s] + codec.pieces[text[s:e]][1] for s in range(max(0, e - codec.longest), e) if text[s:e] in codec.pieces]
        best.append(max(fits, default=best[e - 1] + codec.unknown * len(text[e - 1].encode())))
    return best[-1]


def score_of(codec, ids):
    known = {i: s for i, s in codec.pieces.values()}
    return sum(known.get(i, codec.unknown) for i in ids)


def test_batches_of_streams_give_the_best_segmentation(codec):
    some = [*texts(1, 300, 30), "x" * 5000, "日本" * 300, "ab" * 400, " " * 100, "é" * 70, "a" * 64, "a" * 65, "<|endoftext|>" * 20]
    got = codec.encode_all([t.encode() for t in some])
    assert codec.decode_all(got) == [t.encode() for t in some]
    assert got == [codec.encode(t.encode()) for t in some]
    for t, ids in zip(some, got, strict=True):
        ids = np.frombuffer(ids, "<u4").tolist()
        if t:
            assert ids == [i for part in codec._stream(" " + t) for i in part]
            assert abs(score_of(codec, ids) - best_score(codec, t)) < 1e-6
        else:
            assert ids == []


def test_private_characters_do_not_change_the_rest(codec):
    plain, with_one = (np.frombuffer(codec.encode(t.encode()), "<u4").tolist() for t in ("some words and more words", "some words \ue000 and more words"))
    assert with_one[:2] == plain[:2] and with_one[-3:] == plain[-3:] and len(with_one) == len(plain) + 4


def test_bytes_that_are_not_utf8_come_back(codec):
    some = [b"\xff\xfe abc \xe2", b"plain", b"", b"\xc3", b"\xa9 \xf0\x9f"]
    assert codec.decode_all(codec.encode_all(some)) == some


def test_stream_commits_before_the_end(codec):
    parts = list(codec.viterbi("▁" + "international" * 200))
    assert len(parts) > 50 and max(map(len, parts)) < 40


def test_encoded_and_decoded_keep_other_columns(spark):
    frame = spark.createDataFrame([(1, "a b", "x"), (2, None, "y"), (2, "", "y")], "doc_id long, text string, ids string")
    back = sentencepiece.decoded(sentencepiece.encoded(frame, MODEL), MODEL)
    assert back.columns == ["doc_id", "text", "ids", "decoded"]
    assert sorted(bytes(r.decoded) for r in back.collect()) == [b"", b"", b"a b"]


def test_token_ids_equal_the_plain_library():
    plain, encode = Tokenizer.from_file(BPE), token_files.tokenizer_encode(BPE, special=True)
    some = texts(2, 5000, 14)
    got = encode.many([t.encode() for t in some])
    for t, ids in zip(some, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t
    assert encode(b"a\xff b") == np.array(plain.encode("a� b", add_special_tokens=False).ids, "<u4").tobytes()


def test_files_are_bounded_and_in_order(spark, tmp_path):
    rows = [(k % 97, f"text {k} " + "word " * (k % 50)) for k in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    encode = token_files.tokenizer_encode(BPE)
    made = token_files.write_ids(frame, f"file://{tmp_path}/files", encode, 2, file_ids=300).collect()
    assert len(made) > 20 and all(r.n_ids < 300 + 80 for r in made) and sum(r.n_docs for r in made) == len(rows)
    got = sorted(((r.doc_id, r.start, bytes(r.ids)) for r in token_files.read_ids(spark, f"file://{tmp_path}/files", frame.schema["doc_id"].dataType).collect()), key=lambda r: r[1])
    start = 0
    for (k, at, ids), (want, text) in zip(got, sorted(rows), strict=True):
        assert (k, at, ids) == (want, start, encode(text.encode()) + b"\x02\0\0\0")
        start += len(ids) // 4


def test_any_function_of_one_text_can_encode(spark, tmp_path):
    frame = spark.createDataFrame([(2, "b"), (1, None)], "doc_id long, text string")
    token_files.write_ids(frame, f"file://{tmp_path}/own", lambda t: np.frombuffer(t, np.uint8).astype("<u4").tobytes(), 9)
    got = token_files.read_ids(spark, f"file://{tmp_path}/own", frame.schema["doc_id"].dataType).collect()
    assert sorted((r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == [(1, 0, [9]), (2, 1, [98, 9])]
