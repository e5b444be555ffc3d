from __future__ import annotations

import hashlib
import pathlib
from collections import Counter, defaultdict

import pytest

from litscope.llm import token_alignment
from litscope.llm.queries import tokenizer_file
from litscope.llm.token_alignment import Tokenizers, align_tokens

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pair():
    return Tokenizers(A, B)


def whole(pair, text):
    """Tokens of a whole text, placed by their decoded bytes alone: [(id, end)] of both."""
    if not text:
        return None
    data, found = (" " + text).encode(), []
    for ids, table in ((pair.a.encode(" " + text, add_special_tokens=False).ids, pair.a_bytes), (pair.b.encode(text), pair.b_bytes)):
        at, tokens = 0, []
        for i in ids:
            at += len(table[i])
            tokens.append((i, at))
        if b"".join(table[i] for i in ids) != data:
            return None
        found.append(tokens)
    return found


def brute(pair, rows):
    """The result of every row, in order."""
    links, groups, sizes = [], [], []
    for _, text in rows:
        tokens = whole(pair, text)
        if tokens is None:
            links.append([]), groups.append([]), sizes.append((0, 0))
            continue
        a, b = tokens
        ends = sorted({e for _, e in a} & {e for _, e in b})
        links.append([(x, y) for x, e in a for y, f in b if e == f] if len(a) < 3000 else _paired(a, b))
        row, start = [], 0
        for end in ends:
            row.append("|".join(",".join(str(i) for i, e in side if start < e <= end) for side in (a, b)) if len(a) < 3000 else None)
            start = end
        groups.append(row)
        sizes.append((len(a), len(b)))
    counts = Counter(p for row in links for p in row)
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for (i, _), row, parts, (n_a, n_b) in zip(rows, links, groups, sizes):
        digest = None if None in parts else hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""
        best = sum(counts[p] == most[p[1]] for p in row)
        out.append((i, n_a, n_b, len(parts), len(row), best, sum(counts[p] for p in row), digest))
    return out


def _paired(a, b):
    by_end = {e: y for y, e in b}
    return [(x, by_end[e]) for x, e in a if e in by_end]


def check(spark, pair, rows):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = align_tokens(frame, A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    result, expected = sorted(map(tuple, found.collect()), key=key), sorted(brute(pair, rows), key=key)
    assert len(result) == len(expected)
    for ours, theirs in zip(result, expected):
        assert ours[:7] == theirs[:7]
        assert theirs[7] is None or ours[7] == theirs[7]


def test_edges(spark, pair):
    rows = [
        (1, "plain words and more plain words"), (2, None), (3, ""), (4, " "), (5, "  two  blanks "), (6, "tabs\tand\nlines \n\n x"),
        (7, "<|endoftext|> <s> </s> <unk> <0x41> it's"), (8, "naïve café 東京タワー \U0001d11e \U0001f469‍\U0001f4bb ok"), (9, "a ▁mark in it"),
        (10, "no-break space next\u0085line 　wide   line"), (11, "Привет мир, γειά σου κόσμε"), (1, "plain words and more plain words"),
        (None, "an id is missing"), (12, "x"), (13, "́combining ́ mark"), (14, "\x00\x01 control"), (15, "word" * 3000), (16, "many words " * 4000),
        (17, "a   bé éb İ ẞ"), (18, "trailing "), (19, "﻿mark of order"), (20, "\n"),
    ]
    check(spark, pair, rows)
    assert align_tokens(spark.createDataFrame([], "doc_id bigint, text string, row int, links string"), A, B).count() == 0


@pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no test tables")
def test_documents_against_whole_texts(spark, pair):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, pair, rows)


def test_rare_pairs_are_joined(spark, pair, monkeypatch):
    """With few pairs taken as frequent, the others come by the join."""
    monkeypatch.setattr(token_alignment, "FREQUENT", 4)
    check(spark, pair, [(i, f"the word {i} and the word {i % 3} again") for i in range(40)])


def test_small_slices_and_memory(spark, pair, monkeypatch):
    """Texts in slices of a few bytes, and a memory that is emptied again and again."""
    monkeypatch.setattr(token_alignment, "SLICE", 50)
    monkeypatch.setattr(token_alignment, "REMEMBERED", 5)
    known = token_alignment.Aligned()
    import pyarrow as pa

    texts = ["one two three", None, "three four five six seven", "été à la plage", "", "x" * 200]
    batch = pa.RecordBatch.from_pydict({"id": list(range(6)), "text": texts})
    spans = list(token_alignment._slices(batch.column("text")))
    assert [s for s, _ in spans][1:] == [e for _, e in spans][:-1] and spans[0][0] == 0 and spans[-1][1] == 6
    parts = [token_alignment._aligned(batch.slice(s, e - s), pair, known).to_pylist() for s, e in spans]
    digests = [r["groups_sha256"] for p in parts for r in p]
    assert digests == [r[7] for r in brute(pair, list(enumerate(texts)))]


def test_cuts_inside_characters(pair):
    """Offsets and spans are refined where a character is in several tokens."""
    for text in (" \U0001d11e\U0001d11e x", " 𓀀", " é\U0001f9ff\U0001f9ff"):
        data = text.encode()
        for ids, ends in (pair.a_tokens(text, data), pair.b_tokens(text, data)):
            assert ends[-1] == len(data) and (ends[1:] > ends[:-1]).all()
        ids, ends = pair.b_tokens(text, data)
        assert [data[s:e] for s, e in zip([0, *ends[:-1]], ends)] == [pair.b_bytes[i] for i in ids]


def test_texts_that_end_or_start_in_white_space(spark, pair):
    """Blanks at the end of a text do not run into those of the next text's start."""
    ends = ["ends in blanks" + " " * n for n in range(1, 6)] + ["ends in a line \n", "ends in tabs \t\t"]
    starts = [" " * n + "starts in blanks" for n in range(1, 6)] + ["\n line", " \t tab"]
    rows = [(i, text) for i, text in enumerate(t for pair_of in zip(ends, starts) for t in pair_of)]
    check(spark, pair, rows + [(100, "    "), (101, "ﬁ 漢 "), (102, " 漢")])


def test_few_chunks_in_a_call(spark, pair, monkeypatch):
    monkeypatch.setattr(token_alignment, "TOGETHER", 2)
    known = token_alignment.Aligned()
    import pyarrow as pa

    texts = ["one two three four five", "a ▁mark and a▁nother mark", "six seven one  ", "  two"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(4)), "text": texts})
    digests = [r["groups_sha256"] for r in token_alignment._aligned(batch, pair, known).to_pylist()]
    assert digests == [r[7] for r in brute(pair, list(enumerate(texts)))]
