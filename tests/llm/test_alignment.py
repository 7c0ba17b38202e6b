"""Cross-tokenizer alignment against both tokenizers applied to whole texts, token by token."""

from __future__ import annotations

import os
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm import alignment
from tests.llm.helpers import awkward, documents

pytestmark = pytest.mark.skipif(not os.path.isdir(alignment.TOKENIZERS), reason="tokenizer files are not here")


@pytest.fixture(scope="module")
def whole():
    """text -> (A ids, B ids, links, groups), encoding whole texts with the named files."""
    import sentencepiece
    from tokenizers import Tokenizer

    side_a = Tokenizer.from_file(f"{alignment.TOKENIZERS}/byte_bpe_50k.json")
    side_a.encode_special_tokens = True
    side_b = sentencepiece.SentencePieceProcessor(model_file=f"{alignment.TOKENIZERS}/piece_bpe_32k.model")
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}

    def bytes_a(i):
        return bytes(signs[c] for c in side_a.id_to_token(i))

    def bytes_b(i):
        name = side_b.id_to_piece(i)
        found = re.fullmatch("<0x(..)>", name)
        return bytes([int(found[1], 16)]) if found else name.replace("▁", " ").encode()

    def align(text):
        if not text:
            return [], [], [], ""
        a, b, line = side_a.encode(" " + text, add_special_tokens=False).ids, side_b.encode(text), (" " + text).encode()
        if b"".join(map(bytes_a, a)) != line or b"".join(map(bytes_b, b)) != line:
            return [], [], [], ""
        ends_a, ends_b = np.cumsum([len(bytes_a(i)) for i in a]).tolist(), np.cumsum([len(bytes_b(i)) for i in b]).tolist()
        links, groups, part, i, j = [], [], ([], []), 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            end_a, end_b = ends_a[i] <= ends_b[j], ends_b[j] <= ends_a[i]
            part[0].extend([str(a[i])] * end_a)
            part[1].extend([str(b[j])] * end_b)
            if end_a and end_b:
                groups.append("|".join(map(",".join, part)))
                part = ([], [])
            i, j = i + end_a, j + end_b
        return a, b, links, ";".join(groups)

    return align


def check(docs, whole, digest=False):
    out, pairs = alignment.align(docs, digest=digest)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    rows = [(r.doc_id, *whole(r.text)) for r in docs.select("doc_id", "text").collect()]
    count = Counter(link for row in rows for link in row[3])
    in_docs = Counter(link for row in rows for link in set(row[3]))
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    expected = [
        (i, len(a), len(b), groups.count(";") + (groups != ""), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), groups)
        for i, a, b, links, groups in rows
    ]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)
    got = {(r.a_id, r.b_id): (r.docs, r.links, r.best) for r in pairs.collect()}
    assert got == {x: (in_docs[x], n, n == best[x[1]]) for x, n in count.items()}


TEXTS = [
    "The old bridge, built in 1890, isn't there any more.", "two  spaces\tand\n\nlines \r\n", " leading and trailing ", "x", "  ", "\n",
    "日本語のテキスト と English", "Привет мир", "é é ﬁ 💡💡 a b   c d", "<|endoftext|> </s> <s> <unk> <0x41>", "a▁b and more", "▁",
    "a\x00b\x1c\x85c ​ d᠎e", "don't DON'T we'll '", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "same same same same same same same", "same same",
    "tab\tx y", "ǅ ʰ ₁ ½ Ⅷ", "﻿bom", "न‍क", "0123456789 1,234.5%", "x ́ y",
]


def test_texts_of_all_kinds(spark, whole):
    check(documents(spark, [*TEXTS, None, "", *TEXTS[:3]]), whole)


def test_awkward_table(spark, whole):
    check(awkward(spark), whole)


def test_small_chunks_and_dense_bitmaps(spark, whole, monkeypatch):
    texts = [f"the word{i % 3} the {'and ' * (i % 7)}end" for i in range(120)]
    df = documents(spark, texts).repartition(3)
    check(df, whole)
    assert alignment.postings(df).where("dense").count() > 0


def test_empty_table(spark):
    out, pairs = alignment.align(documents(spark, ["x"]).limit(0))
    assert out.count() == 0 and pairs.count() == 0


def test_random_texts_by_word_equal_whole_texts(whole):
    both = alignment.tokenizers(alignment.TOKENIZERS)
    assert both.by_word
    random = np.random.default_rng(5)
    signs = list("abcdeABC 019.,'\"-_/()\t\n  éßñ€漢▁💡 ́")
    for _ in range(400):
        text = "".join(random.choice(signs, int(random.integers(1, 60))))
        made = list(alignment.chunk_rows(alignment.pa.array([1]), [text], both, False))[0]
        a, b, links, groups = whole(text)
        assert made["groups"].to_pylist() == [groups], repr(text)
        assert [made[n].to_pylist()[0] for n in ("n_a", "n_b", "n_links")] == [len(a), len(b), len(links)]


def test_planes_and_scores_come_back():
    pa = alignment.pa
    pairs, docs, times = np.array([3, 3, 3, 9]), np.array([0, 1, 5, 2]), np.array([1, 6, 3, 1])
    rows = list(alignment.planes(pairs, docs, times, 6))
    links = sum((r["n"].to_numpy() << r["plane"].to_numpy()).sum() for r in rows)
    assert links == 11 and sum(r["docs"].to_numpy().sum() for r in rows) == 4
    arrays = {name: pa.concat_arrays([r[name] for r in rows]) for name in ("plane", "dense", "bits", "pair")}
    pair = arrays.pop("pair").to_numpy()
    table = pa.table({**arrays, "chunk": np.full(len(pair), 7), "links": pair * 10, "best": pair == 3})
    got = alignment.chunk_scores(table).to_pydict()
    assert got == {"chunk": [7] * 4, "doc": [0, 1, 2, 5], "count_sum": [30, 180, 90, 90], "n_best": [1, 6, 0, 3]}


def test_text_and_digest_agree(spark):
    df = documents(spark, TEXTS)
    texts, digests = (alignment.align(df, digest=d)[0] for d in (False, True))
    hashed = texts.withColumn("groups", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)))
    assert sorted(map(tuple, hashed.collect())) == sorted(map(tuple, digests.collect()))
