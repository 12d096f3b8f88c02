import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import awkward_documents, empty_documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobstrata.llm import bpe_duckdb, token_planes

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_duckdb.read_ranks(RANKS),
                             special_tokens={})


# ---- planes ----


@pytest.mark.parametrize("kind", [1, 8])
@settings(max_examples=40, deadline=None)
@given(ids=st.lists(st.integers(0, 2**32 - 1), max_size=200))
def test_planes_round_trip(kind, ids):
    array = np.array(ids, np.uint32)
    planes = token_planes.to_planes(array, kind)
    assert (token_planes.from_planes(planes, len(ids), kind) == array).all()


def test_words_give_the_ids_of_whole_texts(library):
    texts = ["don't. we'll' a's! <|endoftext|>b c<|endoftext|>.", "Σας ΑΣ. «a».", "a1b2.3,4", "x" * 500 + "!!!", "a\x1cb c",
             "İ xİ. İİ!", prose(300, 1)] + [f"ab{chr(c)}cd x{chr(c)}. {chr(c)}y! E{chr(c)}" for c in range(1, 0x2100, 7)]
    mine = token_planes.Encoder(WORD_BPE)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(b"".join(mine.encode(text)), "<u4").tolist() == want.ids


def test_new_words_of_letters_are_asked_for_together(library):
    mine, asked = token_planes.Encoder(WORD_BPE), []
    alone = mine._library
    mine._library = lambda texts: asked.extend(texts) or alone(texts)
    text = "Harbour qzxv èrereau Σίσυφος 日本語 наречие qzxv harbour, ab12 \u0958\u0930 İstanbul"
    assert np.frombuffer(b"".join(mine.encode(text)), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert sorted(asked) == sorted(["", ",", "ab12", "\u0958\u0930", "İstanbul"])
    asked.clear()
    assert mine._joined(["ab", "c1d"]) == alone(["ab", "c1d"]) and asked == ["ab", "c1d"]  # more pieces than words


def test_long_texts_are_cut_where_it_does_not_matter(library, monkeypatch):
    monkeypatch.setattr(token_planes, "_PIECE", 50)
    text = prose(400, 2) + " " + "y" * 300 + " end"
    assert "".join(token_planes.pieces(text, 50)) == text
    assert "".join(bpe_duckdb.pieces(text, 50)) == text


@pytest.mark.parametrize("kind,block", [(1, 64), (8, 1000)])
def test_files_hold_all_documents_in_order(spark, library, kind, block):
    docs = awkward_documents(spark).withColumn("start", F.lit("clash"))
    manifest = token_planes.write(docs, WORD_BPE, kind=kind, block=block)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_planes.read(manifest).collect())
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    start, want = 0, []
    for r, e in zip(rows, library.encode_batch([r.text or "" for r in rows], add_special_tokens=False)):
        ids = np.array(e.ids + [1], "<u4")
        want.append((start, r.doc_id, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want


def test_no_documents_no_files(spark):
    manifest = token_planes.write(empty_documents(spark), WORD_BPE)
    assert manifest.count() == 0 and token_planes.read(manifest).count() == 0


# ---- byte-level BPE ----


def test_merges_agree_with_the_library(reference):
    bpe = bpe_duckdb.load(RANKS, public_tokenizers.PATTERN)
    dice = np.random.default_rng(0)
    texts = ["", " ", "  two  spaces\n\n three ", "a" * 1001, "ab" * 300 + "   ", "ng" * 400, "\n\n x\t y", "日本語日本語 12345!!??",
             "".join(dice.choice(list("abcdefgh"), 800)), prose(200, 1), "i'm we'll 's"]
    texts += [f"ab{chr(c)}cd {chr(c)} x{chr(c)}. 1{chr(c)}" for c in range(1, 0x3000, 11)]
    coded = bpe.encode(texts)
    for text, ids in zip(texts, coded):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
    assert [d.decode() for d in bpe.decode(coded)] == texts


@settings(max_examples=30, deadline=None)
@given(text=st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_round_trip_of_any_text(text):
    bpe = bpe_duckdb.load(RANKS, public_tokenizers.PATTERN)
    assert bpe.decode(bpe.encode([text]))[0] == text.encode()


def test_round_trip_of_documents(spark, reference):
    docs = awkward_documents(spark).withColumn("n_tokens", F.lit("clash"))
    got = bpe_duckdb.round_trip(docs, RANKS, public_tokenizers.PATTERN, keep_ids=True)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    for r, d in zip(sorted(got.collect(), key=key), sorted(docs.collect(), key=key), strict=True):
        ids = np.array(reference.encode_ordinary(d.text or ""), "<u4").tobytes()
        assert (r.n_tokens, bytes(r.ids)) == (len(ids) // 4, ids)
        assert r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
    assert bpe_duckdb.round_trip(empty_documents(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def _counting(bpe, monkeypatch):
    """The words that the encoder asks its recursion for."""
    asked = []
    merge = bpe._merge
    monkeypatch.setattr(bpe, "_merge", lambda words, *more: asked.extend(words) or merge(words, *more))
    return asked


def test_only_words_are_remembered(reference, monkeypatch):
    bpe = bpe_duckdb.Bpe(RANKS, public_tokenizers.PATTERN)
    asked = _counting(bpe, monkeypatch)
    text = "zqharbour, zqharbour! zqharbour... été, (été)\nzqharbour zqa's zq4u \u0250q. 'zq''"
    for _ in range(2):
        assert np.frombuffer(bpe.encode([text])[0], "<u4").tolist() == reference.encode_ordinary(text)
    assert len(asked) == len(set(asked)) and set(bpe.known) == set(asked) == {w for w in bpe.split(text)}


def test_forgotten_words_are_found_again(reference, monkeypatch):
    monkeypatch.setattr(bpe_duckdb, "CACHE_WORDS", 40)
    monkeypatch.setattr(bpe_duckdb, "_NEW_BYTES", 64)
    bpe = bpe_duckdb.Bpe(RANKS, public_tokenizers.PATTERN)
    for seed in range(12):
        texts = [prose(30, seed) + ", " + "x" * seed * 9 + "; " + prose(8, seed // 2) + ".\n", "über, Straße! " * seed]
        for text, ids in zip(texts, bpe.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)


def test_stretches_known_to_be_words_agree_with_the_pattern():
    split = bpe_duckdb.regex.compile(public_tokenizers.PATTERN).findall
    for c in map(chr, range(1, 0x600)):
        for chunk in (f" {c}", f"a{c}", f" é{c}", f" {c}b,", f"z{c}'.", f" x{c}\"?!", f"{c}''"):
            if bpe_duckdb._one_word(chunk):
                assert split(chunk) == [chunk]
            elif parts := bpe_duckdb._word_and_marks(chunk):
                assert split(chunk) == parts
    for text in ("", "a", " a", "a ", "a  b", "a b", "a\n b", "a \nb", "a\x1c b", "\xa0 b", "a b c"):
        odd = text[:1] == " " or text[-1:] == " " or any(
            p == " " and (text[k].isspace() or text[k + 2].isspace()) for k, p in enumerate(text[1:-1]))
        assert bool(bpe_duckdb._ODD.search(text)) == odd


def test_a_batch_is_not_held_as_strings_and_its_memory_is_given_back(spark, monkeypatch):
    """A batch is turned into strings group by group, and Arrow's memory is released after every batch."""
    import pyarrow as pa

    held = []
    groups = bpe_duckdb._groups

    def watched(texts):
        held.append(isinstance(texts, list))
        return groups(texts)

    class Frame:  # runs the function of mapInArrow here
        def __init__(self, df):
            self.df, self.columns, self.schema = df, df.columns, df.schema

        def mapInArrow(self, run, schema):  # noqa: N802
            released = []
            pool = type("Pool", (), {"release_unused": lambda self: released.append(1)})()
            monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
            batch = pa.RecordBatch.from_pydict({"_text": ["one two", None, "three"] * 5, "doc_id": list(range(15))})
            out = list(run(iter([batch, batch])))
            return len(out), sum(b.num_rows for b in out), len(released)

        def select(self, *columns):
            return Frame(self.df.select(*columns))

        def drop(self, *columns):
            return self.df.drop(*columns)

    monkeypatch.setattr(bpe_duckdb, "_groups", watched)
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert bpe_duckdb.round_trip(Frame(docs), RANKS, public_tokenizers.PATTERN) == (2, 30, 2)
    assert held == [False, False]
