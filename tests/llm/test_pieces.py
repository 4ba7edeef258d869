import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskweave.llm import pieces as p
from riskweave.llm.queries import op2_sentencepiece
from tests.llm.cases import no_docs, odd_docs

RAW = open(p.MODEL, "rb").read()
MACHINE = p.Transducer(RAW)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=p.MODEL)


def ids(machine, text):
    return np.frombuffer(machine.encode(text), np.int32).tolist()

ALPHABET = [*" \t\n▁abcdehinrst.,<0x>é東ÿ😀\x00", "   ", "the ", "tion"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=60).map("".join) | st.text(max_size=40))
def test_bpe_equals_the_library(text):
    if "\ud800" <= max(text, default="") <= "\udfff":
        return
    assert ids(MACHINE, text) == LIBRARY.encode(text)
    assert MACHINE.decode(ids(MACHINE, text)) == LIBRARY.decode(LIBRARY.encode(text)) == text.replace("▁", " ")


def test_whole_table_equals_the_library(spark, sf):
    rows = op2_sentencepiece(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()
    assert len(rows) == 200
    for r in rows:
        assert r.round_trip and r.ids == LIBRARY.encode(r.text) and r.n_pieces == len(r.ids)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(p, "MEMORY", 8)
    monkeypatch.setattr(p, "PAIRS", 8)
    machine = p.Transducer(RAW)
    for text in ("the cat sat on the mat and the dog", "a b c d e f g the cat", "x" * 300):
        assert ids(machine, text) == LIBRARY.encode(text)


def message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, bytes):
            out += bytes([number << 3 | 2, len(value)]) + value
        elif isinstance(value, float):
            out += bytes([number << 3 | 5]) + np.float32(value).tobytes()
        else:
            key = number << 3
            out += (bytes([key]) if key < 128 else bytes([key & 127 | 128, key >> 7])) + bytes([value])
    return out


def unigram_model(byte_fallback):
    words = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if byte_fallback:
        words += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    words += [("▁", -2.0, 1), ("a", -3.0, 1), ("b", -3.5, 1), ("ab", -4.0, 1), ("▁a", -3.2, 1), ("ba", -4.1, 1), ("▁aba", -6.0, 1)]
    raw = b"".join(message((1, message((1, w.encode()), (2, s), (3, t)))) for w, s, t in words)
    raw += message((2, message((3, 1), (35, int(byte_fallback)))))
    return raw + message((3, message((1, b"identity"), (3, 1), (4, 0), (5, 1))))


@pytest.mark.parametrize("byte_fallback", [False, True])
def test_unigram_shortest_path_by_brute_force(byte_fallback):
    machine = p.Transducer(unigram_model(byte_fallback))

    def best(text):
        """The least cost over all ways to cut a text."""
        if not text:
            return 0.0
        options = [-machine.score[machine.piece_id[text[:n]]] + best(text[n:]) for n in range(1, len(text) + 1) if text[:n] in machine.piece_id]
        if text[0] not in machine.piece_id:
            options.append(machine.unknown_cost + best(text[1:]))
        return min(options)

    rng = np.random.default_rng(0)
    for _ in range(200):
        text = "".join(rng.choice(list("aaabb c"), rng.integers(0, 9)))
        got = ids(machine, text)
        if "c" not in text:
            assert sum(-machine.score[i] for i in got) == pytest.approx(best(machine.normalise(text)))
            assert machine.decode(got) == text
        elif byte_fallback:
            assert machine.decode(got) == text
        else:
            assert machine.unknown in got


def test_decode_is_the_inverse_in_tables(spark):
    rows = p.decode(p.encode(odd_docs(spark).withColumn("decoded_", F.lit(1)))).collect()
    assert len(rows) == 11
    for r in rows:
        assert r.decoded == (None if r.text is None else r.text)
        assert (r.ids is None) == (r.text is None)
    assert p.encode(no_docs(spark), check="ok").collect() == []
    wild = spark.createDataFrame([([99999, -1, 1, None, 100, 3 + 0xFF],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in p.decode(wild).collect()] == ["a�", None, ""]
