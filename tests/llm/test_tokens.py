"""Piece encoding and packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_frames import LONG, ODD_TEXTS, SF_DIR, documents
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tallyline.llm import packing, pieces
from tallyline.llm.queries import QUERIES

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")


def texts_of(spark, count):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return [row.text for row in table.orderBy("doc_id").limit(count).collect()]


def all_paths_best(codec, text):
    """The best score over every way to cut the text, by plain recursion from the end."""
    scores = {piece: codec.lattice.automaton.get(piece)[2] for piece in codec.lattice.automaton.keys()}
    best = [0.0] + [float("-inf")] * len(text)
    for stop in range(1, len(text) + 1):
        for start in range(stop):
            score = scores.get(text[start:stop])
            if score is None and stop - start == 1:
                score = codec.lattice.unknown
            if score is not None:
                best[stop] = max(best[stop], best[start] + score)
    return best[-1]


def as_unigram_model(raw):
    """The model file with its kind of model set to the one whose best path is by scores."""

    def number(data, at):
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    def fields(data):
        at = 0
        while at < len(data):
            begin = at
            tag, at = number(data, at)
            if tag & 7 == 0:
                _, at = number(data, at)
            elif tag & 7 == 2:
                size, at = number(data, at)
                at += size
            else:
                at += 4 if tag & 7 == 5 else 8
            yield tag >> 3, data[begin:at]

    out = b""
    for field, body in fields(raw):
        if field == 2:
            _, begin = number(body, 1)
            spec = b"".join(b"\x18\x01" if f == 3 else part for f, part in fields(body[begin:]))
            size, prefix = len(spec), b""
            while size > 127:
                prefix, size = prefix + bytes([size & 127 | 128]), size >> 7
            body = b"\x12" + prefix + bytes([size]) + spec
        out += body
    return out


def test_path_is_the_best_of_all_and_the_librarys(spark):
    codec = pieces.codec(PIECE_MODEL)
    with open(PIECE_MODEL, "rb") as file:
        library = SentencePieceProcessor(model_proto=as_unigram_model(file.read()))
    words = [w for text in texts_of(spark, 40) for w in text.split()[:30]]
    words += ["a  b", "日本語 text 😀é", "   lead", "trail  ", "tab\tnew\n\nline", "\x00\x1c", "한글"]
    for word in words:
        ids, score = codec.encode(word)
        assert ids.tolist() == library.nbest_encode_as_ids(word, 2)[0]
        assert score == all_paths_best(codec, pieces.MARK + word.replace(" ", pieces.MARK))


def test_words_alone_give_the_path_of_the_whole_text(spark):
    codec = pieces.codec(PIECE_MODEL)
    for text in texts_of(spark, 30):
        marked = pieces.MARK + text.replace(" ", pieces.MARK)
        ids, score = codec.encode(text)
        whole, whole_score = codec._encode(marked)
        assert (ids.tobytes(), score) == (whole, whole_score)


def test_encode_and_decode_odd_rows(spark):
    given = documents(spark, ODD_TEXTS)
    encoded = pieces.encode_documents(given, PIECE_MODEL)
    rows = encoded.collect()
    assert len(rows) == len(ODD_TEXTS) and all(row.round_trip for row in rows)
    assert all(row.n_ids == len(row.ids) for row in rows)
    read = pieces.decode_documents(encoded.selectExpr("*", "'x' AS text"), PIECE_MODEL).collect()
    want = [(doc_id, text or "") for doc_id, text in ODD_TEXTS]
    assert sorted(map(tuple, read), key=repr) == sorted(want, key=repr)
    mark = documents(spark, [(1, f"a{pieces.MARK}b")])
    assert not pieces.encode_documents(mark, PIECE_MODEL).first().round_trip
    assert pieces.encode_documents(documents(spark, []), PIECE_MODEL).count() == 0


def test_query_reads_back_every_document(spark):
    rows = QUERIES["op4_sentencepiece"](spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(row.round_trip for row in rows)


def test_fast_ids_are_the_files_ids(spark):
    ids = packing.Ids(BYTE_MODEL)
    tokenizer = Tokenizer.from_file(BYTE_MODEL)
    draw = random.Random(1)
    letters = " abAB'1.\n\t　éñ\x1c\x85​日s<|endoftext|>"
    texts = texts_of(spark, 100) + ["".join(draw.choices(letters, k=draw.randint(0, 20))) for _ in range(5000)]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>é日", "<|endoftext|", LONG, "don't  'll  I'm ' s", "\n \n a", "\x00", "ÅÄÖ 12 ½ ²"]
    assert np.frombuffer(ids("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]
    for text in texts:
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        assert ids(text) == want.tobytes()


def checked(spark, rows, frame, capacity=packing.CAPACITY):
    """Every token in its place, sequences gapless; the number of sequences and tokens."""
    placed = packing.pack(frame, BYTE_MODEL, capacity).collect()
    tokenizer = Tokenizer.from_file(BYTE_MODEL)
    want = defaultdict(int)
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for piece, (start, length) in enumerate(packing.cut(len(ids), capacity)):
            assert length == capacity or piece == 0
            want[doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())] += 1
    got = defaultdict(int)
    sequences = defaultdict(list)
    for row in placed:
        got[row.doc_id, row.piece, row.start, row.length, row.ids_crc32] += 1
        sequences[row.sequence_id].append((row.offset, row.length))
    assert got == want
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), sum(row.length for row in placed)


def test_packs_odd_rows(spark):
    rows = [*ODD_TEXTS, (30, "a <|endoftext|> b"), (31, "<|endoftext|>")]
    rows += [(20, "word " * 5000), (20, "word " * 5000), (21, "x" * 2047)]
    for capacity in (7, packing.CAPACITY):
        some = [row for row in rows if capacity > 7 or row[1] != LONG]
        checked(spark, some, documents(spark, some), capacity)
    assert packing.pack(documents(spark, []), BYTE_MODEL).count() == 0


def test_query_packs_tightly(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(row.doc_id, row.text) for row in table.collect()]
    sequences, tokens = checked(spark, rows, table)
    assert sequences <= -(-tokens // packing.CAPACITY) + 2


def one_by_one(counts, capacity):
    """Best fit, longest first, a piece at a time: the sequences it opens."""
    gaps = []
    for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fits = [k for k, gap in enumerate(gaps) if gap >= length]
        if fits:
            best = min(fits, key=lambda k: gaps[k])
            gaps[best] -= length
        else:
            gaps.append(capacity - length)
    return sorted(gaps)


@pytest.mark.parametrize("seed", range(5))
def test_runs_give_what_single_pieces_give(seed):
    draw = random.Random(seed)
    capacity = 50
    counts = {length: draw.randrange(1, 30) for length in draw.sample(range(1, 51), 20)}
    filled, ranks = defaultdict(int), defaultdict(list)
    for length, first, number, sequence, each, base in packing.plan(counts, capacity):
        ranks[length] += range(first, first + number)
        for k in range(number):
            assert filled[sequence + k // each] == base + k % each * length
            filled[sequence + k // each] += length
    assert {length: sorted(r) for length, r in ranks.items()} == {n: [*range(c)] for n, c in counts.items()}
    assert sorted(capacity - used for used in filled.values()) == one_by_one(counts, capacity)
