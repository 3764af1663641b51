"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

A shingle is ``width`` consecutive words; its weight is its count in the document times
an inverse document frequency between 1 (every document has it) and 2 (one has it), so
that the copies of a large group do not drown each other's common text. Document
frequencies are counted over all documents, by parts and keys (see ``parts``). Improved
consistent weighted sampling draws, for each of bands * rows samples, one shingle and
weight level of a document such that two documents draw alike with the probability of
their weighted Jaccard similarity. Documents that draw alike in all rows of a band share
a bucket.

Documents of the same words (128 bits of BLAKE2 over them) are one *content*, held by its
smallest id. In a bucket every content is paired with the smallest one, its leader; a
leader's contents are compared in cells of bounded size: each is held against the leader,
and the smallest that no link has reached yet is held against all others of the cell,
until each has been reached or held; then those that were reached from different ones are
held against each other.

Contents of different cells of a leader that are not connected by then go through an exact
index of prefixes. Every content lists its shingles from the rarest on. Of two contents at
the similarity, the first shingle in that order that both have must stand where at least
``similarity`` of the one's weight is still to come, and 2 s / (1 + s) of the other's if
that one is no heavier; only such places are posted, and two places meet if the weights
still to come could make up the similarity. What meets is verified. So nothing is lost, a
content is posted once, and contents that share only frequent text do not meet. Links are
verified on all shingles. Connected contents are a class, named by its smallest id.

A document can only have a near-duplicate of another content if shingles that other
documents have too make up ``similarity`` of its weight, so all others stop early. That
and the verification are exact; the buckets are random: a pair at the threshold is missed
with probability (1 - similarity**rows)**bands, below one in ten thousand as set here,
and a content may also be reached through a third.

Defined results: words are runs of a-z, 0-9 and non-ASCII after lower-casing A-Z; a text
of fewer words than ``width`` is one shingle; a text without words (or null) is its own
class. Rows without an id give no result. Rows that share an id are one document, with
the text that sorts first. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm import parts
from tidegate.llm.textkit import IS_BREAK, U64, Texts, Words, from_planes, grouped, member, mix, planes, span_hash, window_hash
from tidegate.sources.shared import drop_dir, kept, written

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 14, 3
#: Keys of the frequencies; with a 40-bit tag a key makes a 64-bit number.
MOST_KEYS = 1 << 23
#: Contents that one task compares with one leader at a time.
CELL = 256
SKETCHES = "head bigint, one bigint, two bigint, members array<bigint>, bands array<bigint>, shingles binary, weights binary"


class Shingles:
    """Distinct shingles of each document of a part: owner (document), hash and count, by owner then hash."""

    def __init__(self, table: pa.Table, width: int):
        table = parts.in_order(table)
        ids = table.column("doc_id").to_numpy()
        fresh = np.ones(len(ids), bool)
        fresh[1:] = ids[1:] != ids[:-1]
        self.ids = ids[fresh]
        self.texts = texts = Texts(table.column("text").filter(pa.array(fresh)), lower=True)
        self.words = words = Words(texts, IS_BREAK)
        hashes = span_hash(texts.buf, words.begin, words.end)
        place = np.flatnonzero(words.window_ok(width))
        found, owner = [window_hash(hashes, width)[place]], [words.text[place]]
        for n in range(1, width):
            short = np.flatnonzero(words.count == n)
            found.append(window_hash(hashes, n, 10 + n)[words.first[short]] if len(short) else np.zeros(0, U64))
            owner.append(short)
        found, owner = np.concatenate(found), np.concatenate(owner)
        order, new = grouped(mix(found ^ mix(owner.astype(U64) + U64(1))))
        first = order[new]
        count = np.diff(np.append(np.flatnonzero(new), len(order)))
        by = np.lexsort((found[first], owner[first]))
        self.owner, self.hash, self.count = owner[first][by], found[first][by], count[by]

    def contents(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of BLAKE2 over each document's words, joined by one space, in two halves."""
        words, buf = self.words, self.texts.buf
        space = np.zeros(len(buf) + 1, np.int8)
        space[words.begin] += 1
        space[words.end] -= 1
        inside = np.cumsum(space[:-1], dtype=np.int8) > 0
        after = words.end[words.end < len(buf)]
        keep, joined = inside.copy(), buf.copy()
        keep[after[~inside[after]]], joined[after[~inside[after]]] = True, 0x20
        edges = np.append(0, np.cumsum(keep))
        body = joined[keep].tobytes()
        out = np.zeros((2, len(self.ids)), U64)
        for i, (a, b) in enumerate(zip(edges[self.texts.start].tolist(), edges[self.texts.stop].tolist(), strict=True)):
            out[:, i] = np.frombuffer(hashlib.blake2b(body[a:b].strip(b" "), digest_size=16).digest(), U64)
        return out[0], out[1]


def _placed(hashes: np.ndarray, n_keys: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash's key and its 40-bit tag within the key."""
    key, high = parts.placed(hashes, n_keys)
    return key, (high << U64(8)) | (hashes & U64(0xFF))


def count_frequencies(table: pa.Table) -> pa.Table:
    """For one key: add up the documents of each tag; tell each part those of its tags that several documents have."""
    tags = [from_planes(x, U64) for x in table.column("data").to_pylist()]
    counts = np.concatenate([from_planes(x, np.uint32) for x in table.column("extra").to_pylist()]).astype(np.int64)
    joined = np.concatenate(tags)
    order, new = grouped(joined << U64(24))
    first = np.flatnonzero(new)
    total = np.empty(len(joined), np.int64)
    total[order] = np.repeat(np.add.reduceat(counts[order], first), np.diff(np.append(first, len(order))))
    edges = np.append(0, np.cumsum([len(t) for t in tags]))
    cut = [(t[total[a:b] > 1], total[a:b][total[a:b] > 1]) for t, a, b in zip(tags, edges[:-1], edges[1:], strict=True)]
    out = pa.table(
        {
            "part": table.column("part"),
            "key": table.column("key"),
            "data": pa.array([planes(t) for t, _ in cut], pa.binary()),
            "extra": pa.array([planes(np.minimum(c, 0xFFFFFFFF).astype(np.uint32)) for _, c in cut], pa.binary()),
        }
    )
    return out.filter(pa.array([len(t) > 0 for t, _ in cut]))


def inverse_frequency(documents: np.ndarray, n_docs: int) -> np.ndarray:
    """From 2 for a shingle of one document almost down to 1 for one of all documents."""
    return 1 + np.log((1 + n_docs) / (1 + np.asarray(documents, np.float64))) / np.log(1 + n_docs)


@lru_cache(maxsize=1)
def _gamma() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at the middle of 2**16 equal steps."""
    x = np.concatenate((np.geomspace(1e-6, 1, 200_000), np.linspace(1, 40, 200_000)[1:]))
    return np.interp((np.arange(1 << 16) + 0.5) / (1 << 16), 1 - (1 + x) * np.exp(-x), x).astype(np.float32)


def sample(hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray, draw: int) -> np.ndarray:
    """One consistent weighted sample of each document as a hash; documents begin at ``starts`` and have shingles.

    For a shingle of weight w with r, c ~ Gamma(2, 1) and b uniform, all taken from the
    shingle's hash: t = floor(log w / r + b) and log a = log c - r * (t - b + 1). The
    least a is drawn; what is drawn is the shingle together with t.
    """
    bits = mix(hashes + U64((draw + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    gamma = _gamma()
    r = gamma[(bits & U64(0xFFFF)).astype(np.int64)]
    log_c = np.log(gamma)[((bits >> U64(16)) & U64(0xFFFF)).astype(np.int64)]
    b = ((bits >> U64(32)) & U64(0xFFFF)).astype(np.float32) / np.float32(1 << 16)
    t = np.floor(np.log(weights).astype(np.float32) / r + b)
    log_a = log_c - r * (t - b + 1)
    least = np.minimum.reduceat(log_a, starts)
    is_least = log_a == np.repeat(least, np.diff(np.append(starts, len(hashes))))
    at = np.flatnonzero(is_least)
    drawn = at[np.searchsorted(at, starts)]  # ties go to the smaller hash
    return mix(hashes[drawn] ^ mix(t[drawn].astype(np.int64).astype(U64) + U64(draw)))


def band_values(hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(starts), bands), U64)
    for band in range(bands):
        value = np.full(len(starts), U64(band + 1))
        for row in range(rows):
            value = mix(value ^ sample(hashes, weights, starts, band * rows + row)) + U64(row)
        out[:, band] = value
    return out.view(np.int64)


def weighted_jaccard(one: tuple[np.ndarray, np.ndarray], tags: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Similarity of one document (sorted tags, weights) with each of n others laid end to end."""
    mine, mine_weight = one
    at = np.minimum(np.searchsorted(mine, tags), len(mine) - 1)
    both = mine[at] == tags
    shared = np.bincount(owner[both], weights=np.minimum(mine_weight[at[both]], weights[both]), minlength=n)
    total = np.bincount(owner, weights=weights, minlength=n) + mine_weight.sum() - shared
    return shared / total


#: Pairs of contents that are laid out at a time.
PAIRS = 1 << 20


def similarities(left: list[tuple[np.ndarray, np.ndarray]], right: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weighted Jaccard similarity of each document (sorted tags, weights) of one list with each of another."""

    def flat(side):
        return np.concatenate([t for t, _ in side]), np.concatenate([w for _, w in side]), np.repeat(np.arange(len(side)), [len(t) for t, _ in side])

    (tags, weights, owner), (other_tags, other_weights, other_owner) = flat(left), flat(right)
    total = np.bincount(owner, weights, len(left))[:, None] + np.bincount(other_owner, other_weights, len(right))[None, :]
    both = np.intersect1d(tags, other_tags)

    def by_tag(tags, weights, owner):
        keep = np.flatnonzero(member(tags, both))
        number = np.searchsorted(both, tags[keep])
        keep = keep[np.argsort(number, kind="stable")]
        return weights[keep], owner[keep], np.append(0, np.cumsum(np.bincount(number, minlength=len(both))))

    weights, owner, edge = by_tag(tags, weights, owner)
    other_weights, other_owner, other_edge = by_tag(other_tags, other_weights, other_owner)
    n, m = np.diff(edge), np.diff(other_edge)
    shared = np.zeros((len(left), len(right)))
    # tags of many documents one by one, the others many at a time
    wide = n * m > 4096
    for k in np.flatnonzero(wide):
        a, b = slice(edge[k], edge[k + 1]), slice(other_edge[k], other_edge[k + 1])
        shared[np.ix_(owner[a], other_owner[b])] += np.minimum.outer(weights[a], other_weights[b])
    rare = np.flatnonzero(~wide)
    block = np.cumsum(n[rare] * m[rare]) // PAIRS
    for tags_of_block in np.split(rare, np.flatnonzero(np.diff(block)) + 1):
        size = n[tags_of_block] * m[tags_of_block]
        k = np.repeat(tags_of_block, size)
        at = np.arange(len(k)) - np.repeat(np.cumsum(size) - size, size)
        i, j = edge[k] + at // m[k], other_edge[k] + at % m[k]
        pair = owner[i] * len(right) + other_owner[j]
        shared += np.bincount(pair, np.minimum(weights[i], other_weights[j]), shared.size).reshape(shared.shape)
    return shared / (total - shared)


def joining(like: np.ndarray, roots: np.ndarray, other_roots: np.ndarray) -> list[tuple[int, int]]:
    """Of the similar pairs (row, column), enough to connect the roots that they connect."""
    row, column = np.nonzero(like & (roots[:, None] != other_roots[None, :]))
    pairs = np.stack((roots[row], other_roots[column]), 1)
    _, first = np.unique(pairs, axis=0, return_index=True)
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while x in up:
            x = up[x]
        return x

    out = []
    for k in np.sort(first):
        a, b = top(int(pairs[k, 0])), top(int(pairs[k, 1]))
        if a != b:
            up[max(a, b)] = min(a, b)
            out.append((int(row[k]), int(column[k])))
    return out


def loaded_sketches(table: pa.Table, shingles: str = "shingles", weights: str = "weights") -> list[tuple[np.ndarray, np.ndarray]]:
    """(sorted tags, weights) of each row."""
    out = []
    for tags, own in zip(table.column(shingles).to_pylist(), table.column(weights).to_pylist(), strict=True):
        tags = from_planes(tags, U64)
        order = np.argsort(tags)
        out.append((tags[order], from_planes(own, np.float32).astype(np.float64)[order]))
    return out


def compare_cell(table: pa.Table, similarity: float) -> list[tuple[int, int]]:
    """Links of one cell: enough of them that what is similar, directly or through others, is connected."""
    ids = np.array(table.column("head").to_pylist(), np.int64)
    order = np.argsort(ids, kind="stable")
    sketch = loaded_sketches(table)
    ids, tags, weights = ids[order], [sketch[i][0] for i in order], [sketch[i][1] for i in order]
    owner = np.repeat(np.arange(len(ids)), [len(t) for t in tags])
    flat_tags, flat_weights = np.concatenate(tags), np.concatenate(weights)
    open_ = np.ones(len(ids), bool)
    links, leads = [], []
    while open_.any():
        lead = int(np.flatnonzero(open_)[0])
        open_[lead] = False
        like = weighted_jaccard((tags[lead], weights[lead]), flat_tags, flat_weights, owner, len(ids)) >= similarity - 1e-9
        like[lead] = False
        open_ &= ~like
        leads.append(lead)
        links += [(lead, int(i)) for i in np.flatnonzero(like)]
    # leads were held against all; what two of them reached was not held against each other
    roots = np.arange(len(ids))
    for a, b in links:
        roots[roots == roots[b]] = roots[a]
    reached = np.setdiff1d(np.arange(len(ids)), leads)
    if len(np.unique(roots[reached])) > 1:
        documents = [(tags[i], weights[i]) for i in reached]
        like = similarities(documents, documents) >= similarity - 1e-9
        links += [(int(reached[i]), int(reached[j])) for i, j in joining(like, roots[reached], roots[reached])]
    return [(int(ids[a]), int(ids[b])) for a, b in links]


def sketches(docs: DataFrame, width: int, similarity: float, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """Contents that may have near-duplicates, once for each part: ids, content hashes, band values, shingles."""
    n = parts.part_count(docs, text_col)
    n_keys = min(n, MOST_KEYS)
    parted = parts.parted(docs, n, id_col, text_col)
    n_docs = max(1, docs.where(F.col(id_col).isNotNull()).count())

    def send(table: pa.Table) -> pa.Table:
        part = parts.part_id(table)
        found = Shingles(table, width)
        order, new = grouped(found.hash)
        counts = np.diff(np.append(np.flatnonzero(new), len(order))).astype(np.uint32)
        key, tag = _placed(found.hash[order[new]], n_keys)
        by_key = np.lexsort((tag, key))
        return parts.rows_by_key(key[by_key], part, tag[by_key], counts[by_key])

    def sketch(table: pa.Table, replies: pa.Table) -> pa.Table:
        names = ["head", "one", "two", "members", "bands", "shingles", "weights"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        nothing = pa.table([pa.array([], t) for t in types], names=names)
        if not len(table) or not len(replies):
            return nothing
        found = Shingles(table, width)
        held = np.concatenate([from_planes(x, U64) | U64(k << 40) for k, x in zip(replies.column("key").to_pylist(), replies.column("data").to_pylist(), strict=True)])
        counts = np.concatenate([from_planes(x, np.uint32) for x in replies.column("extra").to_pylist()])
        order = np.argsort(held)
        held, counts = held[order], counts[order]
        key, tag = _placed(found.hash, n_keys)
        number = (key << U64(40)) | tag
        common = np.flatnonzero(member(number, held))
        frequency = np.ones(len(number), np.int64)
        frequency[common] = counts[np.searchsorted(held, number[common])]
        weight = found.count * inverse_frequency(frequency, n_docs)
        n_own = len(found.ids)
        whole = np.bincount(found.owner, weights=weight, minlength=n_own)
        shared = np.bincount(found.owner[common], weights=weight[common], minlength=n_own)
        one, two = found.contents()
        may = (whole > 0) & (shared >= similarity * whole * (1 - 1e-9))
        order, new = grouped(mix(one + mix(two.copy())))
        head = np.empty(n_own, np.int64)
        head[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        chosen = may & (head == np.arange(n_own))
        keep = chosen[found.owner]
        owner, hashes, weight = found.owner[keep], found.hash[keep], weight[keep].astype(np.float32)
        heads = np.flatnonzero(chosen)
        if not len(heads):
            return nothing
        starts = np.searchsorted(owner, heads)
        values = band_values(hashes, weight.astype(np.float64), starts, bands, rows)
        stops = np.append(starts[1:], len(owner))
        rarest = np.lexsort((hashes, frequency[keep], owner))  # the order of the prefixes
        hashes, weight = hashes[rarest], weight[rarest]
        copies = np.flatnonzero(may & ~chosen)
        members: dict[int, list[int]] = {int(h): [] for h in heads}
        for i in copies:
            members[int(head[i])].append(int(found.ids[i]))
        return pa.table(
            [
                pa.array(found.ids[heads]),
                pa.array(one[heads].view(np.int64)),
                pa.array(two[heads].view(np.int64)),
                pa.array([members[int(h)] for h in heads], types[3]),
                pa.ListArray.from_arrays(pa.array(np.arange(len(heads) + 1, dtype=np.int32) * bands), pa.array(values.reshape(-1))),
                pa.array([planes(hashes[a:b] >> U64(24)) for a, b in zip(starts, stops, strict=True)], pa.binary()),
                pa.array([planes(weight[a:b]) for a, b in zip(starts, stops, strict=True)], pa.binary()),
            ],
            names=names,
        )

    asked = parted.groupBy("part").applyInArrow(send, parts.ENTRIES)
    frequencies = asked.groupBy("key").applyInArrow(count_frequencies, parts.REPLIES)
    return parted.groupBy("part").cogroup(frequencies.groupBy("part")).applyInArrow(sketch, SKETCHES)


#: Rows of a few numbers each that are sent to every executor instead of shuffling sketches.
BROADCAST_ROWS = 1 << 20


def light(rows: DataFrame) -> DataFrame:
    """A written table of numbers, to be broadcast if it has few rows."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def connected(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node of a link is connected with, by large and small stars.

    Every round hangs nodes under smaller ones until the links are stars around the
    smallest; the number of rounds grows with the logarithm of the longest chain. A node's
    smallest neighbour is written before it is joined to the node's links, so both sides
    of the join are plain shuffles and a hub's links are split over tasks. A round's
    folders go when the next ones are written.
    """
    spark = links.sparkSession
    edges, folder = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links")

    def mark(frame: DataFrame):
        return tuple(frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def least(frame: DataFrame) -> tuple[DataFrame, str]:
        return written(frame.groupBy("u").agg(F.min("v").alias("m")), "least")

    before = mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low, low_folder = least(both)
        large = both.where("v > u").join(low.select("u", F.least("u", "m").alias("m")), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, large_folder = written(large.where("u != v").distinct(), "large-stars")
        drop_dir(spark, low_folder)
        low, low_folder = least(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges, following = written(small.where("u != v").distinct(), "links")
        for old in (folder, low_folder, large_folder):
            drop_dir(spark, old)
        folder, after = following, mark(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after


POSTS = "tag bigint, head bigint, root bigint, total double, rest double, light boolean"
#: Relative slack for the rounding of stored weights.
SLACK = 1e-5


def prefix_posts(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """The places of each content (head, root, shingles, weights) at which a first common shingle can stand.

    ``rest`` is the weight from there on; ``light`` places are those for heavier partners.
    """
    for batch in batches:
        for head, root, tags, weights in zip(*(batch.column(c).to_pylist() for c in ("head", "root", "shingles", "weights")), strict=True):
            tags, weights = from_planes(tags, U64), from_planes(weights, np.float32).astype(np.float64)
            rest = np.cumsum(weights[::-1])[::-1]
            total = float(rest[0])
            n = int(np.count_nonzero(rest >= similarity * total * (1 - SLACK)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tags[:n].view(np.int64)),
                    pa.array(np.full(n, head, np.int64)),
                    pa.array(np.full(n, root, np.int64)),
                    pa.array(np.full(n, total)),
                    pa.array(rest[:n]),
                    pa.array(rest[:n] >= 2 * similarity / (1 + similarity) * total * (1 - SLACK)),
                ],
                names=["tag", "head", "root", "total", "rest", "light"],
            )


def meeting(posts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of contents of different roots that may have the similarity; a is the lighter one."""
    one = posts.where("light").select("tag", *(F.col(c).alias(f"{c}_a") for c in ("head", "root", "total", "rest")))
    two = posts.select("tag", *(F.col(c).alias(f"{c}_b") for c in ("head", "root", "total", "rest")))
    lighter = (F.col("total_a") < F.col("total_b")) | ((F.col("total_a") == F.col("total_b")) & (F.col("head_a") < F.col("head_b")))
    near = F.col("total_a") >= similarity * (1 - SLACK) * F.col("total_b")
    enough = F.least("rest_a", "rest_b") >= similarity / (1 + similarity) * (1 - SLACK) * (F.col("total_a") + F.col("total_b"))
    met = one.join(two, "tag").where((F.col("root_a") != F.col("root_b")) & lighter & near & enough)
    return met.select(F.col("head_a").alias("a"), F.col("head_b").alias("b")).distinct()


def verified(pairs: DataFrame, heads: DataFrame, similarity: float) -> DataFrame:
    """The written pairs (a, b) whose weighted Jaccard similarity is reached."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = pa.Table.from_batches([batch.slice(at, 64)])
                one, two = loaded_sketches(some, "shingles_a", "weights_a"), loaded_sketches(some, "shingles_b", "weights_b")
                like = [weighted_jaccard(x, *y, np.zeros(len(y[0]), np.int64), 1)[0] >= similarity - 1e-9 for x, y in zip(one, two, strict=True)]
                yield from some.select(["a", "b"]).filter(pa.array(like)).to_batches()

    some = kept(pairs.select(F.explode(F.array("a", "b")).alias("head")).distinct(), "verified-heads")
    needed = kept(heads.select("head", "shingles", "weights").join(light(some), "head"), "verified-sketches")
    for side in ("a", "b"):
        own = needed.select(F.col("head").alias(side), F.col("shingles").alias(f"shingles_{side}"), F.col("weights").alias(f"weights_{side}"))
        pairs = pairs.join(own, side)
    return pairs.mapInArrow(verify, "a bigint, b bigint")


def between_cells(dealt: DataFrame, roots: DataFrame, heads: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between contents of leaders with several cells that are not connected yet.

    ``dealt`` has leader, head and cell.
    """
    several = dealt.where("cell > 0").select("leader").distinct()
    some = dealt.join(several, "leader", "left_semi").select("head").unionByName(several.select(F.col("leader").alias("head"))).distinct()
    rooted = some.join(roots.withColumnRenamed("node", "head"), "head", "left").withColumn("root", F.coalesce("root", "head"))
    posts = heads.select("head", "shingles", "weights").join(light(kept(rooted, "rooted")), "head").mapInArrow(lambda batches: prefix_posts(batches, similarity), POSTS)
    pairs = meeting(kept(posts, "posts"), similarity)
    return verified(kept(pairs, "meeting"), heads, similarity)


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, group_id (the smallest id of its class), content_id (of its words) and n_links of its content.

    ``n_links`` counts the verified links that connect the class and have the content at an
    end. It is not the number of all contents similar to it: contents that are already
    connected are not held against each other.
    """
    spark = docs.sparkSession
    found, folder = written(sketches(docs, width, similarity, bands, rows, id_col, text_col), "sketches")
    contents = kept(found.groupBy("one", "two").agg(F.min("head").alias("content_id")), "contents")
    named = kept(found.select("head", "members", "one", "two").join(contents, ["one", "two"]), "named")
    chosen = light(contents.select(F.col("content_id").alias("head")))
    heads = kept(found.select("head", "bands", "shingles", "weights").join(chosen, "head"), "heads")
    drop_dir(spark, folder)  # a content of several parts had a sketch in each

    places = heads.select("head", F.posexplode("bands").alias("band", "value"))
    buckets = places.groupBy("band", "value").agg(F.min("head").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # a bucket's contents are dealt to cells by their own hash, so no task meets a leader's whole following
    met = places.join(buckets, ["band", "value"]).where("head != leader").groupBy("leader", "head").agg(F.max("n").alias("n"))
    dealt = kept(met.select("leader", F.pmod(F.xxhash64("head"), F.ceil(F.col("n") / CELL)).alias("cell"), "head"), "pairs")
    leaders = dealt.select("leader", "cell", F.col("leader").alias("head")).distinct()
    loaded = heads.select("head", "shingles", "weights").join(light(kept(dealt.unionByName(leaders), "cells")), "head")

    def compare(table: pa.Table) -> pa.Table:
        links = compare_cell(table, similarity)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    links = kept(loaded.groupBy("leader", "cell").applyInArrow(compare, "a bigint, b bigint").distinct(), "verified")
    roots = connected(links)
    if not dealt.where("cell > 0").isEmpty():
        more = kept(between_cells(dealt, roots, heads, similarity), "links-between-cells")
        if not more.isEmpty():
            roots = connected(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
            links = links.unionByName(more)
    degree = links.select(F.explode(F.array("a", "b")).alias("content_id")).groupBy("content_id").agg(F.count(F.lit(1)).alias("n_links"))
    # a row is a content of a part, so a content that many documents have is one row for each part, until its ids are listed
    own = named.select("content_id", F.concat(F.array("head"), "members").alias("ids"))
    classes = own.join(roots.withColumnRenamed("node", "content_id"), "content_id", "left").join(degree, "content_id", "left")
    classes = classes.select("content_id", "root", "n_links", F.explode("ids").alias("doc_id"))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    return ids.join(classes, "doc_id", "left").select(
        "doc_id",
        F.coalesce("root", "content_id", "doc_id").alias("group_id"),
        F.coalesce("content_id", "doc_id").alias("content_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )
