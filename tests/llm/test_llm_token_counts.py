"""Token counts against the library itself."""

import random

import public_tokenizers
import pytest
import sentencepiece

from wagelens.llm import token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def counted(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.n_tokens for r in token_counts.count_tokens(df, MODEL).orderBy("doc_id").collect()]


def wanted(texts):
    return [len(LIBRARY.encode(t or "")) for t in texts]


def test_given_texts(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("text").collect()
    texts = [r.text for r in rows]
    assert counted(spark, texts) == wanted(texts)


def test_odd_texts(spark):
    draw = random.Random(1)
    letters = "ab th ing  \n\t▁'’\"#$%()=;:.,-_/<>123½٣éßñŁЖщאبकไ한国の日́‍😀\0\x01�"
    texts = ["".join(draw.choices(letters, k=draw.randint(1, 60))) for _ in range(1_500)]
    texts += ["", None, " ", "   ", "\n", "▁", " ▁ x", "<s> </s> <unk> <0x0A>", "a" * 300, " a" * 300, "=" * 70, "x  " * 50]
    texts += ["the " * 20_000, "国" * 5_000, "é\n" * 2_000, "Don't, 12 o'clock", "it's  3.14159%", "a b c", "line\r\nline"]
    assert counted(spark, texts) == wanted(texts)


def test_long_texts_and_a_small_memory(spark, monkeypatch, small):
    shortcut = token_counts.prove(MODEL)
    monkeypatch.setattr(token_counts, "PIECE", 100)
    monkeypatch.setattr(token_counts, "PRE_TOKENS", 7)
    monkeypatch.setattr(token_counts, "FEW", 10)
    monkeypatch.setattr(token_counts, "KEPT", 20)
    monkeypatch.setattr(token_counts, "KEPT_LENGTH", 5)
    counter = token_counts.Counter(MODEL, shortcut)
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    assert [counter.count(t or "") for t in texts] == wanted(texts)
    assert len(counter.known) < len(shortcut.whole) + 60


def test_what_is_proven(spark):
    shortcut = token_counts.prove(MODEL)
    assert len(shortcut.whole) > 20_000 and "▁the" in shortcut.whole and "the" in shortcut.whole
    assert not any("▁" in w.lstrip("▁") for w in shortcut.whole)
    model = LIBRARY
    for word in random.Random(3).sample(sorted(shortcut.whole), 500):
        ids = model.encode("\n" + word)
        assert [model.id_to_piece(i) for i in ids[2:]] == [word]


def test_rows_and_columns(spark):
    rows = [(1, "a b", "x", 7), (1, "a b", "y", 8), (None, None, None, None), (2, "", "z", 9), (3, "é " * 5_000, "z", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, n_bytes long")
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(df, MODEL).collect())
    n = len(LIBRARY.encode("é " * 5_000))
    assert n > 4096
    assert got == [(-1, 0, 0, False), (1, 3, 2, False), (1, 3, 2, False), (2, 0, 0, False), (3, 15_000, n, True)]
    assert token_counts.count_tokens(df.limit(0), MODEL).count() == 0


def field(number, value):
    """A field in the wire format: a number, or bytes under 128 long."""
    return bytes([*([number << 3] if number < 16 else [number << 3 & 127 | 128, number >> 4]), value]) if isinstance(value, int) else bytes([number << 3 | 2, len(value)]) + value


@pytest.mark.parametrize(
    ("piece", "trainer", "normalizer"),
    [
        (field(1, b"ab"), field(3, 1), field(4, 0)),  # unigram model
        (field(1, b"ab"), field(3, 2), field(4, 1)),  # repeated blanks go
        (field(1, b"ab"), field(3, 2), field(4, 0) + field(2, b"xyz")),  # characters are mapped
        (field(1, b"ab") + field(3, 4), field(3, 2), field(4, 0)),  # a piece that is matched first
    ],
)
def test_a_model_that_is_not_proven_is_refused(tmp_path, piece, trainer, normalizer):
    path = tmp_path / "other.model"
    path.write_bytes(field(1, piece) + field(2, trainer) + field(3, normalizer))
    with pytest.raises(ValueError):
        token_counts._settings(str(path))


def test_a_piece_across_a_blank_is_refused():
    with pytest.raises(ValueError):
        token_counts.classes(["ab", "a▁b"])
