"""Word-piece counts, memoised ids, sentencepiece, packing and sequence files against the libraries."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer, models

from gamecast.llm import arrowseq, packing, spm, tokencount, tokenids

ALPHABET = "abcdeéüñßİΣ 日\U0001F600.,|'1²\n\t \x1c▁<>"


def library_ids(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def loaded(vocab):
    return {k: tokenids.loaded(k, vocab(f)) for k, f in
            ((tokenids.SpacedWordIds, "byte_bpe_50k.json"), (tokenids.BareWordIds, "word_bpe_49k.json"))}


@settings(max_examples=300, deadline=None)
@given(st.text(ALPHABET, max_size=40))
def test_memoised_ids_are_the_librarys(loaded, text):
    for words in loaded.values():
        assert np.frombuffer(words.text(text), "<u2").tolist() == words.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", "endoftext", " ", "\n", "a", "word", "é"]),
                max_size=8).map("".join))
def test_added_tokens_inside_a_text_are_the_librarys(loaded, text):
    for words in loaded.values():
        assert np.frombuffer(words.text(text), "<u2").tolist() == words.library.encode(text, add_special_tokens=False).ids


def test_the_end_token_is_one_id(loaded):
    ids = np.frombuffer(loaded[tokenids.SpacedWordIds].text("a <|endoftext|> b"), "<u2").tolist()
    assert ids == [64, 220, 50256, 275]


def test_memo_tables_stay_bounded(loaded, monkeypatch):
    words = loaded[tokenids.SpacedWordIds]
    monkeypatch.setattr(tokenids, "CACHE_WORDS", 10)
    for k in range(30):
        words.text(f"word{k} one two three four")
        words.trim()
    assert len(words) <= 20 and len(words.before) <= 30


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=4), max_size=12), st.lists(st.text("abc", min_size=1, max_size=4), max_size=12),
       st.text("abcd", min_size=1, max_size=15))
def test_automaton_counts_greedy_word_pieces(initial, continuing, word):
    automaton = tokencount.LongestMatch(initial, continuing)
    vocab, at, n = (set(initial), set(continuing)), 0, 0
    while at < len(word) and n >= 0:
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocab[at > 0]), None)
        at, n = (end, n + 1) if end else (at, -1)
        if end is None:
            break
    assert automaton.count(word) == n


def test_word_piece_counts_match_the_library(spark, vocab, odd_documents):
    starts, goes_on = tokencount.sentencepiece_vocabulary(vocab("piece_bpe_32k.model"))
    ids = {p: k for k, p in enumerate(dict.fromkeys([*starts, *("##" + p for p in goes_on), "[UNK]"]))}
    library = models.WordPiece(ids, unk_token="[UNK]", max_input_chars_per_word=10**9)
    got = tokencount.token_counts(odd_documents, vocab("piece_bpe_32k.model")).collect()
    want = [(r.doc_id, len(w), sum(len(library.tokenize(x.decode())) for x in w))
            for r in odd_documents.collect() for w in [(r.text or "").encode().split()]]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_sentencepiece_matches_the_library(spark, vocab, odd_documents):
    path = vocab("piece_bpe_32k.model")
    sp = SentencePieceProcessor(model_file=path)
    got = spm.encode_decode(odd_documents, path, check_texts=True).collect()
    want = [(r.doc_id, len(i), i, sp.decode(i) if i else "") for r in odd_documents.collect() for i in [sp.encode(r.text or "")]]
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, want))
    digests = spm.encode_decode(odd_documents.where("doc_id = 1"), path, digest=True).first()
    ids = sp.encode(odd_documents.where("doc_id = 1").first().text)
    assert digests.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(ALPHABET, max_size=40))
def test_agenda_matches_the_library(text):
    import public_tokenizers
    pieces = spm._pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert pieces.encode(text)[1] == pieces.library.encode(text)
    pieces.check()


@pytest.mark.parametrize("text", ["two  blanks", "a break \nafter a blank", "\nfirst a break"])
def test_a_wrong_id_of_an_irregular_text_is_noticed(vocab, text):
    pieces = spm.MergePieces(vocab("piece_bpe_32k.model"))
    pieces.encode(text)
    pieces.check()
    agenda = pieces.agenda
    pieces.agenda = lambda chunk: agenda(chunk)[::-1] + [5]
    pieces.encode(text)
    with pytest.raises(ValueError):
        pieces.check()


def test_a_wrong_id_is_noticed(vocab):
    pieces = spm.MergePieces(vocab("piece_bpe_32k.model"))
    pieces.encode("some words")
    pieces["words"] = ("1", (1,))
    with pytest.raises(ValueError, match="differ"):
        pieces.check()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_and_packing(spark, vocab, odd_documents):
    path = vocab("word_bpe_49k.json")
    rows = packing.pack(packing.token_pieces(odd_documents, path), group_pieces=5).collect()
    want = [(r.doc_id, k, at, len(ids[at:at + 2048]), crc(ids[at:at + 2048])) for r in odd_documents.collect()
            for ids in [library_ids(path, r.text) + [0]] for k, at in enumerate(range(0, len(ids), 2048))]
    assert sorted(str(tuple(r)[:5]) for r in rows) == sorted(map(str, want))
    check_bins([(r.sequence_id, r.offset, r.length) for r in rows], 2048)


def check_bins(rows, capacity):
    bins = {}
    for b, at, n in rows:
        bins.setdefault(b, []).append((at, n))
    for items in bins.values():
        end = 0
        for at, n in sorted(items):
            assert at == end
            end += n
        assert end <= capacity
    return len(bins)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=60))
def test_local_search_never_needs_more_bins(sizes):
    sizes = np.array(sizes, np.int64)
    plain, better = packing.pack_sizes(sizes, 60, 0), packing.pack_sizes(sizes, 60)
    n = [check_bins(list(zip(*p, sizes.tolist())), 60) for p in (plain, better)]
    assert n[1] <= n[0] and n[1] >= -(-int(sizes.sum()) // 60)


def test_local_search_empties_bins():
    rng = np.random.default_rng(3)
    sizes = rng.integers(200, 900, 4000)
    plain, better = (packing.pack_sizes(sizes, 2048, p)[0].max() + 1 for p in (0, packing.PASSES))
    assert better < plain and better <= 1.003 * sizes.sum() / 2048 + 1


def test_too_long_pieces_are_refused():
    with pytest.raises(ValueError):
        packing.pack_sizes(np.array([61]), 60)


def test_sequence_files(spark, vocab, odd_documents):
    path = vocab("byte_bpe_50k.json")
    manifest = arrowseq.write_sequences(odd_documents.repartition(3), path, length=16, rows=4)
    got = arrowseq.read_documents(manifest).collect()
    ids = [(r.doc_id, library_ids(path, r.text) + [0]) for r in odd_documents.collect()]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(d), len(i), crc(i)) for d, i in ids)
    at = 0      # ascending ids, nulls first, without gaps
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order[0] is None and order[1:] == sorted(order[1:])
    files = sorted(manifest.collect(), key=lambda r: r.part)
    one = next(f for f in files if f.n_tokens > 100)
    file = arrowseq.SequenceFile(one.path)
    assert file.length == 16
    stream = np.concatenate(list(file.stream()))
    assert len(stream) == one.n_tokens
    for k in (0, 3, 4, (one.n_tokens - 1) // 16):
        ids, mask = file.sequence(k)
        real = np.array(mask.to_pylist())
        assert ids.base is not None and real.sum() == len(stream[16 * k:16 * k + 16])
        assert (ids[real] == stream[16 * k:16 * k + 16]).all()


def test_empty_tables(spark, vocab, no_documents):
    assert tokencount.token_counts(no_documents, vocab("piece_bpe_32k.model")).count() == 0
    assert spm.encode_decode(no_documents, vocab("piece_bpe_32k.model")).count() == 0
    assert packing.pack(packing.token_pieces(no_documents, vocab("word_bpe_49k.json"))).count() == 0
    assert arrowseq.read_documents(arrowseq.write_sequences(no_documents, vocab("byte_bpe_50k.json"))).count() == 0
