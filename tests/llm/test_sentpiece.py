import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece

from millrace.llm import ragged, sentpiece

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    draw = random.Random(1)
    alphabet = [*"abcdeinst  \n\t'!?,12é ñ漢字の日本語は　  😀<|ﬁ①ا▁", "the", "ing", "    ", "function", "<0x0A>", "<s>", "==", "aaaa"]
    out = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 80))) for _ in range(600)]
    return [*out, None, "", "a" * 1500, "の日本語は" * 300, " " * 900, "-" * 1300, "".join(draw.choice("漢字の日本語はabci") for _ in range(1500))]


def test_ids_are_the_librarys(library):
    model = sentpiece.load(PATH)
    rows = texts()
    ids, sizes = model.encode(*ragged.flat(pa.array(rows)))
    edges = ragged.bounds(sizes)
    for k, text in enumerate(rows):
        assert ids[edges[k] : edges[k + 1]].tolist() == library.encode(text or ""), text
    assert model.decode(ids, sizes) == [library.decode(library.encode(t or "")) for t in rows]


def test_any_chunks_give_the_same_ids(library, monkeypatch):
    monkeypatch.setattr(sentpiece, "CHUNK", 100)
    monkeypatch.setattr(sentpiece, "STRIDE", 40)
    model = sentpiece.PieceModel(PATH)
    for text in texts()[-5:] + ["x" * 99 + " " + "y" * 350 + "漢字", "some ordinary words, with blanks between them; unbelievable characteristics\n" * 20]:
        points, _ = model.normalised(*ragged.flat(pa.array([text])))
        chunks = list(sentpiece.split_chunks(model, points))
        path = sentpiece.best_states([sentpiece.chunk_matrix(model, *c) for c in chunks])
        got = [sentpiece.chunk_ids(model, *c, a, b) for c, a, b in zip(chunks, path, path[1:], strict=False)]
        assert np.concatenate(got).tolist() == library.encode(text)
        assert len(chunks) > 2


def test_cuts_within_words_have_real_matrices(library, monkeypatch):
    """Cuts at fixed places fall into words, where several pieces may cover the cut."""
    model = sentpiece.PieceModel(PATH)
    draw = random.Random(6)
    words = ["unbelievable", "the", "ing", "function", "a", "characteristics", "é", "of", "漢", "  ", "\n"]
    for size in (33, 40, 57):
        monkeypatch.setattr(sentpiece, "CHUNK", size)
        text = " ".join(draw.choice(words) for _ in range(400))
        points, _ = model.normalised(*ragged.flat(pa.array([text])))
        chunks = list(sentpiece.split_chunks(model, points))
        matrices = [sentpiece.chunk_matrix(model, *c) for c in chunks]
        assert sum(max(m.shape) > 1 for m in matrices) > len(points) // size // 2
        assert sum(c[4] - c[3] for c in chunks) == len(points)
        path = sentpiece.best_states(matrices)
        got = [sentpiece.chunk_ids(model, *c, a, b) for c, a, b in zip(chunks, path, path[1:], strict=False)]
        assert np.concatenate(got).tolist() == library.encode(text)


def test_tree_of_matrices(spark, documents, library, monkeypatch):
    monkeypatch.setattr(sentpiece, "CHUNK", 50)
    monkeypatch.setattr(sentpiece, "FOLD", 3)
    draw = random.Random(7)
    rows = [(i, " ".join(draw.choice(["unbelievable", "the", "漢字", "characteristics"]) for _ in range(n))) for i, n in enumerate([3, 12, 60, 400])]
    got = sentpiece.encode(documents(rows), PATH).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got} == {i: library.encode(t) for i, t in rows}


def test_products_are_associative():
    draw = np.random.default_rng(2)
    a, b, c = (np.where(draw.random((4, 4)) < 0.4, 0.0, -np.inf) for _ in range(3))
    both = sentpiece.product([a, b])
    assert (sentpiece.product([both, c]) == sentpiece.product([a, sentpiece.product([b, c])])).all()


def test_tables(documents, odd_rows, library, monkeypatch):
    monkeypatch.setattr(sentpiece, "CHUNK", 1000)
    docs = documents(odd_rows + [(20, "漢字の" * 900)])
    got = sentpiece.decode(sentpiece.encode(docs, PATH), PATH).collect()
    want = {(i, t or "") for i, t in odd_rows} | {(20, "漢字の" * 900)}
    assert len(got) == len(odd_rows) + 1 and {(r["doc_id"], r["text"]) for r in got} == want
    for r in got:
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(r["text"]) and r["n_pieces"] == len(r["ids"]) // 4
    assert sentpiece.encode(documents([]), PATH).count() == 0


def test_texts_with_equal_polynomials(documents):
    word = "".join("in"[bin(k).count("1") % 2] for k in range(2048))
    rows = [(0, word), (1, word.translate({ord("i"): "n", ord("n"): "i"})), (2, "again " + word)]
    both = sentpiece.decode(sentpiece.encode(documents(rows), PATH), PATH).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert {r.doc_id: (r.n_pieces, r.text) for r in both} == {i: (len(library.encode(t)), t) for i, t in rows}
