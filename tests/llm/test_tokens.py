"""Exact ids, coded files and packed sequences."""

import collections
import zlib

import numpy as np
import pytest
from plain import corpus, frame  # noqa: F401

from tickloom.llm import idcoder, packing
from tickloom.llm.common import new_path
from tickloom.llm.queries import vocabulary
from tickloom.llm.tokens import ChunkEncoder

ODD = [
    "", " ", "  ", "a  b", " a", "a \n b", "a\n b  ", "x\x1c y", "<|endoftext|> a<|startoftext|>", "<|ENDOFTEXT|> b. c<|EndOfText|>", "a b<|endoftext|>\u00e9 c,<|endoftext|>\n", "don't 's", "\uff11\uff12 \uff13", "a\t b \r\n",
    "\U0001f642 \U0001f642  \U0001f642", "_ _", "a\u200b b", "e\u0301 \u0301b", "a.b,c ..,, d", "3.14,15 .5", "A.B C, D", "\0 a.\0b", "\u03a3\u03a3. \u0130x", "a_.b_, c",
]
VOCABULARIES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def reference(name, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary(name))
    return [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", VOCABULARIES)
@pytest.mark.parametrize("limit", [5, 100_000])
def test_encoder_is_exact(name, limit):
    encoder = ChunkEncoder(vocabulary(name), limit)
    texts = ODD + [t or "" for _, t in corpus()]
    for part in (texts[:20], texts[20:], texts):
        ids, sizes = encoder.encode(part, 9)
        want = [x + [9] for x in reference(name, part)]
        assert sizes.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]


@pytest.mark.parametrize("name", VOCABULARIES)
def test_signs_after_odd_letters(name):
    """A letter that ends in a mark when it is lower-cased or normalised joins a sign after it; other letters do not."""
    texts = ["\u0130, a", "\u0958. b", "word\u0130.", "abc$$$ abc!? (abc)-d_e", "\u00e9t\u00e9; \u0416: \u4e2d| x@y", "it's, don't. o'"]
    ids, sizes = ChunkEncoder(vocabulary(name)).encode(texts)
    want = reference(name, texts)
    assert sizes.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


@pytest.mark.parametrize("name", VOCABULARIES)
def test_new_words_share_calls(name):
    """The library gets new words many at a time, in one text."""
    encoder = ChunkEncoder(vocabulary(name))
    inner, given = encoder.tokenizer, []

    class Spy:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return inner.encode_batch_fast(texts, **options)

    encoder.tokenizer = Spy()
    rng = np.random.default_rng(3)
    words = ["".join(w) for w in rng.choice(list("abcdefghij"), (5000, 9))]
    texts = [" ".join(words[k : k + 50]) for k in range(0, len(words), 50)]
    ids, sizes = encoder.encode(texts)
    want = reference(name, texts)
    assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    assert len(given) < 300


def test_words_of_latin_letters_share_calls():
    """Also words that end in a letter beyond ASCII; each of these letters, at each place of a word, is spelled as the patterns do."""
    encoder = ChunkEncoder(vocabulary(VOCABULARIES[0]))
    given = []

    class Spy:
        def __init__(self, inner):
            self.inner = inner

        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return self.inner.encode_batch_fast(texts, **options)

    encoder.tokenizer = Spy(encoder.tokenizer)
    if getattr(encoder, "speller", None):
        encoder.speller = Spy(encoder.speller)
    rng = np.random.default_rng(4)
    letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
    words = ["".join(w) for w in np.column_stack([rng.choice([*letters, *"abcxyzABC"], (6000, 6)), np.resize(letters, 6000)])]
    texts = [rng.choice([" ", "\n"]).join(words[k : k + 50]) for k in range(0, len(words), 50)]
    ids, sizes = encoder.encode(texts)
    want = reference(VOCABULARIES[0], texts)
    assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    assert len(given) < 300


def test_numbers_of_pieces_stay():
    """Pieces that were learnt keep their ids when later texts bring others, alone, side by side and spelled ones mixed."""
    encoder = ChunkEncoder(vocabulary(VOCABULARIES[0]))
    for texts in (["a bc d\u017e, e"], ["\u4e2d\u6587 x\u4e2d a bc"], ["e f9 <|endoftext|> bc", " bc", "", "d\u017e, zz \u00fc\u00fc 7\n8 a"], ["", ""], ["a bc d\u017e, e zz"]):
        ids, sizes = encoder.encode(texts)
        want = reference(VOCABULARIES[0], texts)
        assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_places_lead_back():
    """The first and the last place of the span of an id lead back to it, whatever came before."""
    rng = np.random.default_rng(8)
    ids = np.where(rng.random(60_000) < 0.6, np.resize(rng.integers(0, 300, 700), 60_000), rng.zipf(1.3, 60_000) % 50_257).astype(np.uint32)
    model, key = idcoder._Model.fit(ids, 4096)
    one, two = np.roll(ids, 1), np.roll(ids, 2)
    one[::4096], two[::4096], two[1::4096] = 0, 0, 0
    hashed, (start, size) = idcoder._hash(one, two), model.span(ids, key)
    assert size.min() > 0
    for place in (start, start + size - np.uint64(1)):
        got = model.find(place.astype(np.int64), one, hashed)
        assert all(np.array_equal(x, y) for x, y in zip(got, (ids, start, size), strict=True))


def test_blocks_share_the_model():
    """What repeats only beyond a block is predicted too, and each block still decodes from the head and its own words."""
    ids = np.tile(np.random.default_rng(6).permutation(50_000)[:3000], 20)
    data = idcoder.write_segment([1], np.array([len(ids)]), ids, block=1024)
    assert idcoder.read_segment(data)[2].tolist() == ids.tolist()
    assert len(data) < len(ids)


@pytest.mark.parametrize("kind", ["none", "one", "same", "random", "periodic", "largest"])
def test_blocks_round_trip(kind):
    rng = np.random.default_rng(5)
    ids = {
        "none": np.zeros(0, int), "one": np.array([65535]), "same": np.zeros(9000, int), "random": rng.integers(0, 65536, 9000),
        "periodic": np.tile(rng.integers(0, 50000, 37), 300), "largest": np.full(5000, 65535),
    }[kind]
    data = idcoder.write_segment([7, None], np.array([len(ids), 0]), ids, block=1024)
    names, sizes, back = idcoder.read_segment(data)
    assert (names, sizes.tolist(), back.tolist()) == ([7, None], [len(ids), 0], ids.tolist())
    if kind in ("same", "periodic"):
        assert len(data) < len(ids)  # the predictions pay off


def test_damage_is_found():
    ids = np.arange(3000) % 700
    data = bytearray(idcoder.write_segment([1], np.array([3000]), ids))
    for at in (50, len(data) - 40):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            idcoder.read_segment(bytes(broken))
    with pytest.raises(ValueError):
        idcoder.write_segment([1], np.array([1]), np.array([65536]))


def test_files_in_order(spark, frame):
    docs = [*corpus(), (4, "again"), (4, "again"), (None, "no id")]
    path = new_path(spark, "ids")
    idcoder.write_ids(frame(docs), path, vocabulary("byte_bpe_50k.json"), segment_ids=500)
    rows = sorted(idcoder.read_ids(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted([d for d, _ in docs], key=lambda d: (d is not None, d))
    start = 0
    for r in rows:
        assert r["start"] == start and len(r["ids"]) == 4 * r["n_tokens"]
        start += r["n_tokens"]
    want = collections.Counter((d, zlib.crc32(np.array(x + [0], "<u4").tobytes())) for (d, _), x in zip(docs, reference(VOCABULARIES[0], [t or "" for _, t in docs]), strict=True))
    assert collections.Counter((r["doc_id"], zlib.crc32(r["ids"])) for r in rows) == want


def test_empty_table_of_ids(spark, frame):
    path = new_path(spark, "ids")
    idcoder.write_ids(frame([]), path, vocabulary("byte_bpe_50k.json"))
    assert idcoder.read_ids(spark, path).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 7, 300])
def test_assignment(n):
    lengths = np.minimum(np.random.default_rng(n).lognormal(5, 1.4, n).astype(int) + 1, 9000)
    doc, start, length, sequence, offset = packing.assign(lengths)
    filled = collections.defaultdict(list)
    parts = collections.defaultdict(list)
    for d, s, m, q, o in zip(doc, start, length, sequence, offset, strict=True):
        filled[q].append((o, m))
        parts[d].append((s, m))
    for pieces in filled.values():
        at = 0
        for o, m in sorted(pieces):
            assert o == at
            at += m
        assert at <= 2048 and at & (at - 1) == 0
    for d, n_ids in enumerate(lengths):
        at = 0
        for s, m in sorted(parts[d]):
            assert s == at
            at += m
        assert at == n_ids


def test_costs_are_balanced():
    """Full sequences of many short documents and of few long ones cost nearly the same in each, not all short ones in one."""
    lengths = np.array([1000] * 40 + [100] * 400)
    _, _, length, sequence, _ = packing.assign(lengths)
    cost = np.bincount(sequence, length + length.astype(float) ** 2 / 4096)[np.bincount(sequence, length) == 2048]
    assert cost.max() < 1.35 * cost.min()


def test_pack(frame):
    docs = [*corpus(), (4, "again"), (4, "again"), (None, "no id"), (100_000, "long text " * 3000)]
    rows = packing.pack(frame(docs), vocabulary("word_bpe_49k.json"), chunk_tokens=3000).collect()
    got = collections.Counter((r["doc_id"], r["doc_tokens"]) for r in rows if r["start"] == 0)
    want = reference(VOCABULARIES[1], [t or "" for _, t in docs])
    assert got == collections.Counter((d, len(x) + 1) for (d, _), x in zip(docs, want, strict=True))
    long = sorted((r for r in rows if r["doc_id"] == 100_000), key=lambda r: r["start"])
    assert b"".join(bytes(r["ids"]) for r in long) == np.array(want[-1] + [1], "<u4").tobytes()
    assert packing.pack(frame([]), vocabulary("word_bpe_49k.json")).count() == 0


def test_pack_signs_after_odd_letters(frame):
    """Whole texts come back, also where a letter ends in a mark once it is lower-cased."""
    docs = [(1, "İ, a"), (2, None), (3, "aİ. b " * 400)]
    rows = sorted(packing.pack(frame(docs), vocabulary("word_bpe_49k.json")).collect(), key=lambda r: (r["doc_id"], r["start"]))
    for (doc, _), want in zip(docs, reference(VOCABULARIES[1], [t or "" for _, t in docs]), strict=True):
        assert b"".join(bytes(r["ids"]) for r in rows if r["doc_id"] == doc) == np.array(want + [1], "<u4").tobytes()
