"""Cross-tokenizer alignment with inverted pair bitmaps.

Each text is encoded by two tokenizers, A (byte-level BPE, given a space and the text) and B (sentence pieces, which
add the space). Byte offsets where tokens of both end cut the tokens into groups; every pair of token
occurrences that share a byte is a link.

Documents are numbered within chunks. A chunk's postings hold, for each (A id, B id), a compressed bitmap of the chunk's
documents per multiplicity plane: plane k has the documents whose number of links of this pair has bit k set. A plane is kept
as sorted 16-bit numbers or, where that is smaller, as plain bits. Chunks never share documents, so OR-merging a pair's
bitmaps over chunks is putting them side by side: a pair's document count is the sum of the popcounts of its planes' unions,
its link count the sum of the planes' popcounts times two to the plane. Postings joined with the counts return each document its
scores. Texts are encoded once, and the postings are written once to the shared folder.

Neither vocabulary joins characters across a space between two plain characters, so words are encoded apart
and each distinct word of a chunk only once; where a model does not allow that, whole texts are encoded. A word outside plain
Latin goes to the byte-level tokenizer's own file; others to its ranks, the same vocabulary, which encode faster.

Defined results: null and empty texts, and texts that the joined tokens of either side do not give back byte by byte, have no tokens:
zeros, and empty groups. Rows that repeat an id are rows of their own, each counted; a null id is kept. An empty table gives no
rows and no pairs. A very long text is a chunk of its own. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import scratch_folder, stored

TOKENIZERS = "/opt/tokenizers"
#: The pattern that splits text before the merges of the rank file. Fixed value.
SPLITTER = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN = "!-~¡-ɏ"
WORD_GAP = re.compile(f"(?<=[{PLAIN}]) (?=[{PLAIN}])")
PLAIN_TEXT = re.compile(f"[{PLAIN}]+(?: [{PLAIN}]+)*+")
#: Such words may stand in one line, as plain characters stand on both sides of each gap.
PLAIN_WORD = re.compile(f"[{PLAIN}](?:[\t\n\r {PLAIN}]*[{PLAIN}])?")
LINE_WORDS = 256
SPACE_INSIDE = re.compile("[^▁]▁")
BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")
#: A pair is ``a << B_BITS | b``.
B_BITS = 16
CHUNK_DOCS = 1 << 13
CHUNK_BYTES = 4 << 20

POSTINGS = (
    "chunk long, doc int, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "pair long, plane int, docs long, n long, dense boolean, bits binary"
)


class Tokenizers:
    """Both tokenizers with their tables of token bytes, loaded once per Python worker."""

    def __init__(self, folder: str):
        import sentencepiece
        import tiktoken
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        with open(os.path.join(folder, "byte_bpe_50k.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.fast = tiktoken.Encoding("ranks", pat_str=SPLITTER, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(os.path.join(folder, "byte_bpe_50k.json"))
        self.exact.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, "piece_bpe_32k.model"))
        table_a = dict((i, b) for b, i in ranks.items())
        # the one id that only the tokenizer's file has is a special token; it never comes out of a text
        self.bytes_a = [table_a.get(i, b"") for i in range(self.exact.get_vocab_size())]
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.bytes_b = [self.piece_bytes(name) for name in names]
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.pieces.serialized_model_proto())
        spec = model.normalizer_spec
        self.by_word = (
            spec.name == "identity"
            and spec.add_dummy_prefix
            and not spec.remove_extra_whitespaces
            and not any(map(SPACE_INSIDE.search, names))
        )
        self.sizes_a = np.array([len(b) for b in self.bytes_a])
        self.sizes_b = np.array([len(b) for b in self.bytes_b])
        # what stands for a token in the text of groups: in the middle of its list, or at its end
        self.labels = (
            [f"{i}," for i in range(len(self.bytes_a))]
            + [f"{i}|" for i in range(len(self.bytes_a))]
            + [f"{i}," for i in range(len(names))]
            + [f"{i};" for i in range(len(names))]
        )

    @staticmethod
    def piece_bytes(name: str) -> bytes:
        if found := BYTE_PIECE.fullmatch(name):
            return bytes([int(found[1], 16)])
        return name.replace("▁", " ").encode()

    def words(self, text: str) -> list[str]:
        if not self.by_word:
            return [text]
        return text.split(" ") if PLAIN_TEXT.fullmatch(text) else WORD_GAP.split(text)

    def encode_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides of plain words that stand in a line, encoded as lines of many words."""
        lines = [" ".join(words[start : start + LINE_WORDS]) for start in range(0, len(words), LINE_WORDS)]
        return flat([self.fast.encode_ordinary(" " + x) for x in lines])[0], flat(self.pieces.encode(lines, num_threads=1))[0]

    def encode_odd(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        found = self.exact.encode_batch([" " + w for w in words], add_special_tokens=False)
        return [f.ids for f in found], self.pieces.encode(words, num_threads=1)

    def bytes_of(self, ids_a: list[int], ids_b: list[int]) -> tuple[bytes, bytes]:
        return b"".join([self.bytes_a[i] for i in ids_a]), b"".join([self.bytes_b[i] for i in ids_b])


@cache
def tokenizers(folder: str) -> Tokenizers:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizers(folder)


@dataclass
class Aligned:
    """Words with the counts, links and group texts of each; words without tokens have ``good`` false."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    pairs: np.ndarray
    groups: list[str]
    #: place of each given word in the order of all this
    rank: np.ndarray


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def aligned(words: list[str], both: Tokenizers) -> Aligned:
    """Plain words come first, in their order, then the others; pairs of all words stand in a line, ``n_links`` per word."""
    plain = [i for i, w in enumerate(words) if both.by_word and PLAIN_WORD.fullmatch(w)]
    odd = sorted(set(range(len(words))).difference(plain))
    ids_a, ids_b = both.encode_plain([words[i] for i in plain])
    line = "".join([f" {words[i]}" for i in plain]).encode()
    if both.bytes_of(ids_a.tolist(), ids_b.tolist()) != (line, line):
        raise ValueError("the vocabularies do not give plain words back")
    lists_a, lists_b = both.encode_odd([words[i] for i in odd])
    good = np.ones(len(words), bool)
    for at, (i, a, b) in enumerate(zip(odd, lists_a, lists_b)):
        text = b" " + words[i].encode()
        if both.bytes_of(a, b) != (text, text):
            good[i] = False
            lists_a[at] = lists_b[at] = []
    ids_a, ids_b = np.concatenate([ids_a, flat(lists_a)[0]]), np.concatenate([ids_b, flat(lists_b)[0]])
    order = np.array(plain + odd, np.int64)
    lengths = np.array([len(words[i].encode()) + 1 for i in order.tolist()], np.int64) * good[order]
    ends_a, ends_b = np.cumsum(both.sizes_a[ids_a]), np.cumsum(both.sizes_b[ids_b])
    # between two neighbouring ends lies just one link; two sorted runs are merged
    ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    ends = ends[np.concatenate([ends[1:] != ends[:-1], [True]])] if len(ends) else ends
    at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    shared = (ends_a[at_a] == ends) & (ends_b[at_b] == ends)
    cuts = ends[shared]
    # a word without tokens ends where the one before ends: 'left' finds the word that holds the byte
    until = np.cumsum(lengths)
    group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    in_a, in_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
    some_a, some_b = len(both.bytes_a), len(both.bytes_b)
    codes = np.empty(len(ids_a) + len(ids_b), np.int64)
    codes[np.arange(len(ids_a)) + (np.cumsum(in_b) - in_b)[group_a]] = ids_a + some_a * (cuts[group_a] == ends_a)
    codes[np.arange(len(ids_b)) + np.cumsum(in_a)[group_b]] = 2 * some_a + ids_b + some_b * (cuts[group_b] == ends_b)
    labels = [both.labels[i] for i in codes.tolist()]

    def counted(positions: np.ndarray) -> np.ndarray:
        return np.bincount(np.searchsorted(until, positions), minlength=len(words))

    n_a, n_b = counted(ends_a), counted(ends_b)
    stops = np.cumsum(n_a + n_b).tolist()
    groups = ["".join(labels[start:stop]) for start, stop in zip([0, *stops[:-1]], stops)]
    pairs = ids_a[at_a] << B_BITS | ids_b[at_b]
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    return Aligned(good[order], n_a, n_b, counted(cuts), counted(ends), pairs, groups, rank)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every run, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def planes(pairs: np.ndarray, docs: np.ndarray, times: np.ndarray, span: int) -> Iterator[dict[str, pa.Array]]:
    """Postings of one chunk from entries sorted by pair and document: a row per pair and plane that has a document."""
    left = np.concatenate([[True], pairs[1:] != pairs[:-1]]) if len(pairs) else np.zeros(0, bool)
    starts = np.flatnonzero(left)
    in_docs = np.diff(np.append(starts, len(pairs)))
    # the document count stands on a pair's first plane
    plane_of = np.bitwise_or.reduceat(times, starts) if len(starts) else times
    first = np.log2(plane_of & -plane_of).astype(np.int64) if len(starts) else plane_of
    most = (span + 15) // 16 * 2
    for plane in range(int(times.max(initial=0)).bit_length()):
        has = (times >> plane & 1).astype(bool)
        rows = np.flatnonzero(np.logical_or.reduceat(has, starts))
        n = np.add.reduceat(has.astype(np.int64), starts)[rows]
        members = docs[has].astype("<u2")
        dense = 2 * n > most
        stops = np.cumsum(n)
        data = [members[~np.repeat(dense, n)]] if dense.any() else [members]
        sizes = np.where(dense, most, 2 * n)
        yield_rows = np.argsort(dense, kind="stable")
        for row in np.flatnonzero(dense):
            bits = np.zeros(most * 8, bool)
            bits[members[stops[row] - n[row] : stops[row]]] = True
            data.append(np.packbits(bits, bitorder="little").view("<u2"))
        offsets = np.concatenate([[0], np.cumsum(sizes[yield_rows])]).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate(data))]
        rows, n, dense = rows[yield_rows], n[yield_rows], dense[yield_rows]
        yield {
            "pair": pa.array(pairs[starts[rows]]),
            "plane": pa.array(np.full(len(rows), plane, np.int32)),
            "docs": pa.array(np.where(first[rows] == plane, in_docs[rows], 0)),
            "n": pa.array(n),
            "dense": pa.array(dense),
            "bits": pa.Array.from_buffers(pa.binary(), len(rows), buffers),
        }


def chunk_rows(ids: pa.Array, texts: list[str | None], both: Tokenizers, digest: bool) -> Iterator[dict[str, pa.Array]]:
    """One chunk: a row per document, then its postings."""
    index: dict[str, int] = defaultdict(count().__next__)
    held = [[index[w] for w in both.words(t)] if t else [] for t in texts]
    found = aligned(list(index), both)
    words, sizes = flat(held)
    words = found.rank[words]
    if not found.good.all():
        known = np.logical_and.reduceat(found.good[words], (np.cumsum(sizes) - sizes)[sizes > 0])
        words, sizes[sizes > 0] = words[np.repeat(known, sizes[sizes > 0])], sizes[sizes > 0] * known
    doc = np.repeat(np.arange(len(held)), sizes)

    def summed(values: np.ndarray) -> pa.Array:
        totals = np.concatenate([[0], np.cumsum(values[words])]) if len(words) else np.zeros(1, np.int64)
        stops = np.cumsum(sizes)
        return pa.array(totals[stops] - totals[stops - sizes])

    stops = np.cumsum(sizes).tolist()
    texts_of, line = found.groups, words.tolist()
    made = ("".join([texts_of[w] for w in line[start:stop]])[:-1] for start, stop in zip([0, *stops[:-1]], stops))
    if digest:
        made = (hashlib.sha256(m.encode()).hexdigest() if m else "" for m in made)
    yield {
        "doc": pa.array(np.arange(len(held), dtype=np.int32)),
        "doc_id": ids,
        "n_a": summed(found.n_a),
        "n_b": summed(found.n_b),
        "n_groups": summed(found.n_groups),
        "n_links": summed(found.n_links),
        "groups": pa.array(list(made), pa.string()),
    }
    if not len(words):
        return
    keys = np.sort(doc * len(index) + words)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    times = np.diff(np.append(starts, len(keys)))
    doc, word = np.divmod(keys[starts], len(index))
    links = found.n_links[word]
    entries = found.pairs[spread((np.cumsum(found.n_links) - found.n_links)[word], links)] << 13 | np.repeat(doc, links)
    times = np.repeat(times, links)
    order = np.argsort(entries, kind="stable")
    entries, times = entries[order], times[order]
    starts = np.flatnonzero(np.concatenate([[True], entries[1:] != entries[:-1]]))
    times, entries = np.add.reduceat(times, starts), entries[starts]
    yield from planes(entries >> 13, entries & (CHUNK_DOCS - 1), times, len(held))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    for batch in batches:
        texts, start, size = batch.column(1).to_pylist(), 0, 0
        for stop, text in enumerate(texts):
            more = len(text or "")
            if stop - start >= CHUNK_DOCS or (size and size + more > CHUNK_BYTES):
                yield batch.column(0).slice(start, stop - start), texts[start:stop]
                start, size = stop, 0
            size += more
        if texts[start:]:
            yield batch.column(0).slice(start), texts[start:]


def postings(docs: DataFrame, folder: str = TOKENIZERS, digest: bool = False) -> DataFrame:
    """Document rows (``pair`` null) and posting rows of all chunks; not yet stored."""
    schema = POSTINGS.format(id=docs.schema["doc_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, target = tokenizers(folder), None
        # the same split gives the same numbers when a task runs again
        base = TaskContext.get().partitionId() << 32
        for number, (ids, texts) in enumerate(chunks(batches)):
            if target is None:
                types = {"doc": pa.int32(), "doc_id": ids.type, "groups": pa.string(), "plane": pa.int32()}
                types |= {"dense": pa.bool_(), "bits": pa.binary()}
                names = [part.split()[0] for part in POSTINGS.split(", ")]
                target = pa.schema([(name, types.get(name, pa.int64())) for name in names])
            for columns in chunk_rows(ids, texts, both, digest):
                rows = len(next(iter(columns.values())))
                columns["chunk"] = pa.array(np.full(rows, base + number))
                arrays = [columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in target]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, docs, links, best): ``best`` if no other A id has more links with this B id."""
    links = F.sum(F.col("n") * F.expr("shiftleft(1L, plane)"))
    pairs = rows.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("docs").alias("docs"), links.alias("links"))
    b_id = F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))
    pairs = stored(
        pairs.select("pair", F.shiftright("pair", B_BITS).alias("a_id"), b_id.alias("b_id"), "docs", "links"),
        scratch_folder(rows.sparkSession, "alignment-pairs"),
    )
    # at most one row per piece of B's vocabulary
    most = F.broadcast(pairs.groupBy("b_id").agg(F.max("links").alias("most")))
    return pairs.join(most, "b_id").select("pair", "a_id", "b_id", "docs", "links", (F.col("links") == F.col("most")).alias("best"))


def chunk_scores(table: pa.Table) -> pa.Table:
    """(chunk, doc, count_sum, n_best) of the documents of one chunk, from all its posting rows with their pairs' counts."""
    table = table.combine_chunks()
    chunk, plane, dense, bits, links, best = (
        table[name].chunk(0) for name in ("chunk", "plane", "dense", "bits", "links", "best")
    )
    dense = dense.to_numpy(zero_copy_only=False)
    weight = np.left_shift(1, plane.to_numpy().astype(np.int64))
    values = np.stack([weight * links.to_numpy(), weight * best.to_numpy(zero_copy_only=False)])
    offsets = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset : bits.offset + len(bits) + 1]
    data = np.frombuffer(bits.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view("<u2")
    sizes = np.diff(offsets) // 2
    sums = np.zeros((2, CHUNK_DOCS), np.int64)
    listed = np.repeat(~dense, sizes)
    for kind in range(2):
        np.add.at(sums[kind], data[listed], np.repeat(values[kind], sizes)[listed])
    stops = np.cumsum(sizes)
    for row in np.flatnonzero(dense):
        members = np.unpackbits(data[stops[row] - sizes[row] : stops[row]].view(np.uint8), bitorder="little")[:CHUNK_DOCS]
        sums[:, : len(members)] += members * values[:, row][:, None]
    docs = np.flatnonzero(sums[0])
    columns = {"chunk": np.full(len(docs), chunk[0].as_py()), "doc": docs.astype(np.int32), "count_sum": sums[0, docs]}
    return pa.table({**columns, "n_best": sums[1, docs]})


def returned_scores(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(chunk, doc, count_sum, n_best): what the postings return to their documents. A chunk's postings are of bounded size,
    as its texts are; so they meet in one group again, after they have met their pairs' counts."""
    asked = rows.where("pair IS NOT NULL").select("pair", "chunk", "plane", "dense", "bits")
    # one plan at every size: vocabularies of real corpora have more pairs than can be broadcast
    scored = asked.join(pairs.select("pair", "links", "best").hint("merge"), "pair").drop("pair")
    return scored.groupBy("chunk").applyInArrow(chunk_scores, "chunk long, doc int, count_sum long, n_best long")


def align(docs: DataFrame, folder: str = TOKENIZERS, digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """The aligned documents and the pair table.

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups``, like ``a1,a2|b1;a3|b2,b3`` in ids of A
    and B, or with ``digest`` the SHA-256 of that text. Pairs: a_id, b_id, docs, links, best.
    """
    folder_of = scratch_folder(docs.sparkSession, "alignment")
    rows = stored(postings(docs, folder, digest), f"{folder_of}/postings")
    pairs = stored(pair_counts(rows), f"{folder_of}/pairs")
    per_doc = rows.where("pair IS NULL").select("chunk", "doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
    joined = per_doc.join(returned_scores(rows, pairs), ["chunk", "doc"], "left")
    zero = F.lit(0).cast("long")
    documents = joined.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups",
    )
    return documents, pairs.drop("pair")
