import hashlib
import random
import struct

import pyarrow as pa
import pytest

import helpers as H
from carestar.llm import piece_codec as P
from carestar.llm.queries import PIECE_MODEL

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def both():
    with open(PIECE_MODEL, "rb") as f:
        return P.PieceModel(f.read()), sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def agree(both, texts):
    own, lib = both
    ids, ends = own.encode_batch(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, ends[:-1], ends[1:]):
        want = lib.encode(t or "", add_bos=True, add_eos=True)
        assert ids[a:b].tolist() == want, repr(t)
        assert own.decode(ids[a:b]).decode() == lib.decode(want), repr(t)


def test_awkward_texts(both):
    agree(both, [t for _, t in H.AWKWARD])
    agree(both, ["▁", "a▁b", "   ", " a", "a ", "\n\n", "<s>", "</s><0x41>", "ﬁ½", " " * 99, "the" * 400, "ab" * 300, "aaaa" * 40])


def test_random_texts(both):
    rnd, own = random.Random(3), both[0]
    pieces = own.pieces[259:]
    agree(both, ["".join(rnd.choice("abdehinorst  ▁\n\té語🙂0'.—") for _ in range(rnd.randint(0, 150))) for _ in range(1500)])
    agree(both, ["".join(rnd.choice(pieces[:800]) for _ in range(25)) for _ in range(1500)])
    agree(both, ["".join(rnd.choice(pieces) for _ in range(25)) for _ in range(1500)])


def unbroken(size):
    rnd, letters = random.Random(size), "abcdefghijklmnopqrstuvwxyz"
    pick = lambda of, n: "".join(rnd.choice(of) for _ in range(n))
    return [pick(letters, size), pick("acgt", size), pick(letters.upper() + letters + "0123456789+/", size), "the" * (size // 3), "a" * size,
            " " * size, pick(["attention", "station", "the", "ing", "ation", "  "], size // 5), pick("语é🙂ab\u2581", size)]


def test_long_texts_without_breaks(both, monkeypatch):
    rnd, pieces = random.Random(5), [p.lstrip("▁") for p in both[0].pieces[259:]]
    agree(both, unbroken(100_000))
    agree(both, ["".join(rnd.choice(of) for _ in range(20_000)) for of in (pieces, pieces[:600])])
    agree(both, unbroken(3_000) + unbroken(700) + ["short one"] * 3)
    monkeypatch.setattr(P, "LONG", 4)
    agree(both, ["".join(rnd.choice(pieces[:800]) for _ in range(rnd.randint(1, 40))) for _ in range(600)])
    for progress in (1, 50, 1 << 40):
        monkeypatch.setattr(P, "PROGRESS", progress)
        agree(both, unbroken(900) + ["".join(rnd.choice(pieces) for _ in range(30)) for _ in range(300)])


def test_decoding_any_ids(both):
    import numpy as np
    own, lib = both
    rnd = random.Random(4)
    for _ in range(800):
        ids = [rnd.choice([rnd.randint(3, 258), rnd.randint(0, 31_999), 1, 2, 0]) for _ in range(rnd.randint(0, 12))]
        assert own.decode(np.array(ids, np.int64)).decode() == lib.decode(ids), ids


def test_documents(spark, both):
    model = P.read_model(spark, PIECE_MODEL)
    assert model == P.read_model(spark, f"file://{PIECE_MODEL}")
    got = P.encode_documents(H.awkward(spark), model).collect()
    assert len(got) == len(H.AWKWARD)
    texts = {i: t for i, t in H.AWKWARD if i is not None}
    for r in got:
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(r['ids'])}I", *r["ids"])).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest() and r["n_tokens"] == len(r["ids"])
        if r["doc_id"] is not None:
            assert r["ids"] == both[1].encode(texts[r["doc_id"]] or "", add_bos=True, add_eos=True)
    assert P.encode_documents(H.empty(spark), model).count() == 0
