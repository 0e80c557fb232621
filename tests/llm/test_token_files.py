import zlib

import numpy as np
import pytest

from panelgrowth.llm.token_files import (
    BATCH_SEQS, SEQ_LEN, BYTE_CHARS, Encoder, TokenFile, read_token_files, token_digest, write_token_files,
)

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


TEXTS = ["Hello world, it's 42 o'clock.", "", None, " leading", "trailing ", "two  spaces", "tab\tand\nlines\n\n x", "ça va? 日本語 テスト",
         "a" * 5000, "word " * 3000 + "end", " nbsp  x", "x \ny", "<|endoftext|> in <|endoftext|>text", "\U0001F600 \U0001F600", " ", "\n"]


def test_encoder_equals_the_tokenizer(plain):
    got = Encoder(PATH).encode([t or "" for t in TEXTS])
    for t, g in zip(TEXTS, got):
        assert np.frombuffer(g, "<u4").tolist() == plain.encode(t or "", add_special_tokens=False).ids, t


def _expected(rows, plain):
    at, out = 0, []
    for i, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_digest(docs_of, plain):
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)]
    got = sorted(tuple(r) for r in token_digest(docs_of(rows), PATH).collect())
    assert got == _expected(rows, plain)


def test_null_and_repeated_ids(docs_of):
    rows = [(None, "null id"), (5, "five"), (5, "five"), (5, "other five"), (9, None)]
    got = token_digest(docs_of(rows), PATH).collect()
    assert sorted(r["start"] for r in got)[0] == 0 and [r["doc_id"] for r in got if r["start"] == 0] == [None]
    spans = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and len(got) == 5


def test_files_of_fixed_size_lists(docs_of, plain):
    rows = [(i, f"text number {i} " * 900) for i in range(40)]
    folder, manifest = write_token_files(docs_of(rows), PATH, file_ids=40_000)
    assert manifest.count() > 1
    want = {i: plain.encode(t, add_special_tokens=False).ids + [2] for i, t in rows}
    for m in manifest.collect():
        f = TokenFile(folder, m["name"])
        stream = np.concatenate(list(f.stream()))
        assert len(stream) == m["n_ids"]
        for doc, start, n in zip(*(f.index.column(c).to_pylist() for c in ("doc_id", "start", "n_tokens"))):
            assert stream[start:start + n].tolist() == want[doc]
        k = (len(stream) - 1) // SEQ_LEN
        ids, mask = f.sequence(k)
        assert ids[:mask.true_count].tolist() == stream[k * SEQ_LEN:].tolist() and len(ids) == SEQ_LEN
        assert all(f.file.get_batch(j).num_rows == BATCH_SEQS for j in range(f.file.num_record_batches - 1))
    assert read_token_files(folder, manifest).count() == 40


def test_empty(docs_of):
    assert token_digest(docs_of([(1, "a")]).where("doc_id < 0"), PATH).count() == 0


def test_a_blocks_words_are_looked_up_once(plain, monkeypatch):
    import random

    from panelgrowth.llm import token_files
    rng = random.Random(3)
    words = ["it's", "don't!", "hand,", "Hand", "x'", "'s", "été", "ça...", "ʼn", "ñandú!?", "a1", "1a", "--", "...", "日本", "a\tb", "a\nb", "\u3000",
             "\tq", "q\n", "q\xa0", "<|endoftext|>", "a<|endoftext|>", "ab<|", "Ġ", "Ġa", "\xad", "\x00", "word", "ﬁ", "aʼs", "I'll", "'", "×a", "Éa"]
    words += ["".join(rng.choice("abcdefghéçØ") for _ in range(rng.randint(1, 9))) + rng.choice(["", "", ",", "%%%", "'", "?!"])
              for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for cache, block in ((1_000_000, 1 << 20), (60, 300)):  # words are forgotten, and blocks are many
        monkeypatch.setattr(token_files, "CACHE_WORDS", cache)
        monkeypatch.setattr(token_files, "BLOCK_CHARS", block)
        e = Encoder(PATH)
        asked = []
        spaced = e.spaced
        e.spaced = lambda parts: (asked.append(parts), spaced(parts))[1]
        for _ in range(2):
            got = e.encode(texts)
            for t, w, g in zip(texts, want, got):
                assert np.frombuffer(g, "<u4").tolist() == w, t
        assert all(len(set(p)) == len(p) for p in asked)
    assert e.plain and "".join(BYTE_CHARS.get(b, chr(b)) for b in b" \n\xad") == "ĠĊŃ"
