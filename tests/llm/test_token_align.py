import hashlib
from collections import Counter

import pytest

from panelgrowth.llm import token_align
from panelgrowth.llm.token_align import Aligner, Alignment, align_tokens

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(texts):
    """The columns of each text, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer
    ta = Tokenizer.from_file(A)
    ta.encode_special_tokens = True
    tb = sentencepiece.SentencePieceProcessor(model_file=B)
    code = token_align.byte_characters()
    found = []
    for t in texts:
        a = [] if not t else ta.encode(" " + t, add_special_tokens=False).ids
        b = [] if not t else tb.encode(t)
        bytes_a = [bytes(code[c] for c in ta.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(tb.id_to_piece(i)[3:5], 16)]) if tb.is_byte(i) else
                   tb.id_to_piece(i).replace("\u2581", " ").encode() for i in b]
        if not t or b"".join(bytes_a) != (" " + t).encode() or b"".join(bytes_b) != (" " + t).encode():
            found.append(None)
            continue
        ends = []
        for tokens in (bytes_a, bytes_b):
            n, own = 0, []
            for x in tokens:
                own.append((n, n + len(x)))
                n += len(x)
            ends.append(own)
        links, j0 = Counter(), 0
        for i, (s, e) in enumerate(ends[0]):
            while ends[1][j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(b) and ends[1][j][0] < e:
                links[a[i], b[j]] += 1
                j += 1
        common = sorted({e for _, e in ends[0]} & {e for _, e in ends[1]})
        said, low = [], 0
        for c in common:
            said.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, own) if low < e <= c)
                                 for ids, own in ((a, ends[0]), (b, ends[1]))))
            low = c
        found.append((len(a), len(b), len(common), links, hashlib.sha256(";".join(said).encode()).hexdigest()))
    count = Counter(p for f in found if f for p in f[3])
    best = Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    rows = [(0, 0, 0, 0, 0, 0, "") if f is None else (
        f[0], f[1], f[2], sum(f[3].values()), sum(n for p, n in f[3].items() if count[p] == best[p[0]]),
        sum(n * count[p] for p, n in f[3].items()), f[4]) for f in found]
    return rows, count


TEXTS = ["Hello world, it's 42 o'clock.", "", None, " leading", "trailing ", "two  spaces", "tab\tand\nlines\n\n x",
         "\u00e7a va? \u65e5\u672c\u8a9e \u30c6\u30b9\u30c8", "a" * 3000, "word " * 800 + "end", "\u00a0nbsp\u3000 x",
         "x \ny", "<|endoftext|> in <|endoftext|>text <s> </s> <unk> <0x41>", "\U0001F600 \U0001F600", " ", "\n",
         "a \u2581 b", "pre\u2581post", "Hello world, it's 42 o'clock.", "\u0301a e\u0301 \ufb01n", "a\x00b \x7f", "\ufeffx",
         "the the the the", "the", "of the of the"]


@pytest.mark.parametrize("options", [{}, {"slice_docs": 2, "fan_in": 2}, {"slice_records": 50, "fan_in": 3, "buckets": 8}])
def test_documents_equal_brute_force(docs_of, options):
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS)
           for r in align_tokens(docs_of(list(enumerate(TEXTS))), A, B, **options).collect()}
    want, _ = brute(TEXTS)
    for i, t in enumerate(TEXTS):
        assert got[i] == want[i], t


def test_pairs_equal_brute_force(docs_of):
    got = {(r["a"], r["b"]): r["n_docs"] for r in
           Alignment(docs_of(list(enumerate(TEXTS))), A, B, slice_docs=3, fan_in=2).pairs().collect()}
    assert got == dict(brute(TEXTS)[1])


def test_prose_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, _ = brute([t for _, t in rows])
    got = sorted((r["doc_id"], *(r[c] for c in COLUMNS)) for r in align_tokens(docs, A, B, slice_records=20_000).collect())
    assert got == sorted((i, *w) for (i, _), w in zip(rows, want))


def test_a_forgotten_word_is_learnt_again(docs_of, monkeypatch):
    monkeypatch.setattr(token_align, "CACHE_WORDS", 3)
    own = Aligner(A, B)
    for t in ("one two three four", "five", "one two"):
        if own.full():
            own.clear()
        assert own.entries([t])[0] and 0 not in own.entries([t])[0]
    assert len(own.groups) < 5


def test_many_occurrences_overflow_a_record():
    layout = token_align.Layout(1 << 24, 1 << 24, 64)
    assert layout.occ == 2
    import numpy as np
    own = token_align.Slice(layout)
    aligner = Aligner(A, B)
    own.add(aligner, [1], aligner.entries(["the " * 9 + "the"]))
    key = np.concatenate(own.held)
    assert int((key & np.uint64(3)).sum()) == 10


def test_null_and_repeated_ids(docs_of):
    rows = [(None, "null id"), (5, "five"), (5, "five"), (5, "other five")]
    got = sorted(tuple(r) for r in align_tokens(docs_of(rows), A, B).select("n_a", "count_sum", "n_best").collect())
    want, _ = brute([t for _, t in rows])
    assert got == sorted((w[0], w[5], w[4]) for w in want)


def test_empty(docs_of):
    d = docs_of([(1, "a")]).where("doc_id < 0")
    assert align_tokens(d, A, B).count() == 0
    assert Alignment(d, A, B).pairs().count() == 0
