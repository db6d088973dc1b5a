"""Near-duplicate classes by Order MinHash, with candidates verified by banded alignment.

A text's k-mers are its runs of SHINGLE words, labelled with their occurrence (the second "a b c d e"
differs from the first). Each of SAMPLES hash functions orders the labelled k-mers; the PICKS smallest,
put back into text order, are one entry of the sketch. Two texts agree on an entry with a probability
that follows their edit similarity, not only their set similarity (Marcais et al., 2019).

Texts that agree on an entry form a bucket. Every member is linked to the bucket's least document (the
leader), which makes as many candidates as members, never all pairs. A candidate holds if the edit
similarity of the word sequences, 1 - distance / longer length, is SIMILARITY or more; the alignment
works on bit vectors within the band that the threshold allows. Members that are not
similar to their leader get another chance: their buckets are led again without it, so that a node meets
the least document of those left, one for each class, with which it shares most buckets.
What then still belongs to different classes within a bucket is compared pair by pair, so that all pairs
of texts which agree on an entry are either compared or in one class. Only pairs whose numbers of words or
bags of words rule the threshold out (lower bounds of the edit distance) are spared the alignment. Buckets
are cut by the number of words, as similar texts differ little in it. Those with the same largest class
become one group, where a text stands once however many entries it shares, and large groups are cut into
blocks, each pair of which is a task of its own; members of the group's class only meet the others.

Buckets are made twice: of the SEEDS first entries, each node meeting the one leader with which it shares
most of them, and then of all entries, where of each class found so far one node stands in a bucket. So a
large group of near copies brings a row for each of SEEDS entries a node, not for all of SAMPLES.

Equal texts are one node from the start. Classes are the connected components of the links.

Null texts count as empty, and empty texts are copies of each other. Rows with the same doc_id are one
document: they get one class. A row without doc_id is known by a hash of its text. doc_id has to be a
number: one that can't be cast to a whole number is an error. The class id is the least doc_id of the
class. A very long text is one sketch and one slice of memory; its alignment takes memory in proportion to
its length, and time to the square divided by the bits of a block. An empty table gives an empty result.
Only doc_id and text are read; keep_one keeps all columns.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlake.llm import textops as T
from stintlake.llm.components import components
from stintlake.llm.scratch import keep

SHINGLE, PICKS, SIMILARITY = 5, 2, 0.8
#: Entries of a sketch. Near the threshold about a third of the k-mers survive the edits, so that two texts
#: agree on an entry with a chance of some 0.04: 64 entries find nine in ten such pairs, 24 seven in ten.
SAMPLES = 64
#: Entries of the first look, by which most near copies find their class. It only saves work: the second has all.
SEEDS = 8
#: Rows of a file of the stored tables, and of one that holds sketches (some 25 MB).
FILE_ROWS, SKETCH_ROWS = 500_000, 50_000
#: Bins of a bag of words, and nodes of a group that meet as one block by their bags.
BINS, BLOCK = 256, 8192
#: Pairs a row that the bounds may leave before texts meet in blocks, of so many nodes and words.
DENSE, TEXT_BLOCK, BLOCK_WORDS = 8, 1000, 1 << 19
_seed = np.random.default_rng(1905)
_XOR = _seed.integers(0, 1 << 64, SAMPLES, dtype=np.uint64)
_TIMES = _seed.integers(0, 1 << 64, SAMPLES, dtype=np.uint64) | np.uint64(1)
_PLACE = np.uint64((1 << 28) - 1)  # the low bits of an ordered value hold the k-mer's place


def kmers(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled k-mers and their rows, in text order."""
    n = len(at) - 1
    start, end, row = T.words(data, at)
    hashes, row = T.shingles(T.span_hash(T.prefix_hash(data), start, end), row, n, SHINGLE)
    if len(hashes):
        order = np.lexsort((hashes, row))  # stable: text order among equal ones
        h, r = hashes[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        label = np.empty(len(h), np.uint64)
        label[order] = (np.arange(len(h)) - first).astype(np.uint64)
        hashes = np.where(label > 0, T.mix(hashes + label * np.uint64(0x9E3779B97F4A7C15)), hashes)
    return hashes, row


def sketch(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The entries of every row (rows x SAMPLES, 64 bits each; 0 for rows without a word)."""
    n = len(at) - 1
    hashes, row = kmers(data, at)
    out = np.zeros((n, SAMPLES), np.uint64)
    cut = T.per_row(row, n)
    full = np.flatnonzero(np.diff(cut) > 0)
    if not len(full):
        return out
    begin = cut[full]
    place = (np.arange(len(row)) - cut[row]).astype(np.uint64)
    none = np.uint64((1 << 64) - 1)
    for j in range(SAMPLES):
        value = (((hashes ^ _XOR[j]) * _TIMES[j]) & ~_PLACE) | place
        picks = []
        for _ in range(PICKS):
            least = np.minimum.reduceat(value, begin)
            spot = np.where(least == none, -1, begin + (least & _PLACE).astype(np.int64))
            picks.append(spot)
            value[spot[spot >= 0]] = none
        picks = np.sort(np.stack(picks), axis=0)  # text order; -1 where a text has fewer k-mers
        entry = np.full(len(full), np.uint64((j + 1) * 0xD1B54A32D192ED03 % (1 << 64)))
        for spot in picks:
            entry = T.mix(entry ^ np.where(spot >= 0, hashes[spot], np.uint64(7)))
        out[full, j] = entry
    return out


#: Words of the pattern that one row of alignment blocks holds as bits of a number.
ALIGN_BITS = 4096


def within(a: list, b: list, similarity: float = SIMILARITY) -> bool:
    """Whether 1 - edit distance / longer length of two sequences is `similarity` or more.

    Banded alignment on bit vectors (Myers): a is cut into blocks of ALIGN_BITS words, a block's vertical
    differences are two numbers, and a block only sees the columns that the allowed distance leaves it.
    Where a border lies outside the band, differences of +1 stand there: never less than the true ones, and
    a path within the band doesn't use them. Memory grows with a block and b, not with their product.
    """
    n, m = len(a), len(b)
    allowed = int((1 - similarity) * max(n, m) + 1e-9)
    if abs(n - m) > allowed:
        return False
    low = 0
    while low < n and low < m and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(n, m) - low and a[n - 1 - high] == b[m - 1 - high]:
        high += 1
    a, b = a[low : n - high], b[low : m - high]
    n, m = len(a), len(b)
    if max(n, m) <= allowed:
        return True
    if not n or not m:
        return False
    count: dict = {}
    for x in a:
        count[x] = count.get(x, 0) + 1
    for x in b:
        count[x] = count.get(x, 0) - 1
    if max(sum(v for v in count.values() if v > 0), -sum(v for v in count.values() if v < 0)) > allowed:
        return False  # a lower bound of the distance
    above, first = list(range(m + 1)), 0  # distances of a's prefix to b[:first], b[:first + 1], ...
    for top in range(0, n, ALIGN_BITS):
        block = a[top : top + ALIGN_BITS]
        begin, end = max(0, top - allowed), min(m, top + len(block) + allowed)
        above = _align(block, b[begin:end], above[begin - first :])
        first = begin
        if min(above) > allowed:
            return False
    return above[-1] <= allowed


def _align(block: list, columns: list, above: list) -> list:
    """The distances below a block: above has those over it, from the place before its first column on;
    where above ends, they rise by one a column."""
    places: dict = {}
    for i, x in enumerate(block):
        places[x] = places.get(x, 0) | 1 << i
    every, bottom = (1 << len(block)) - 1, 1 << (len(block) - 1)
    plus, minus, last = every, 0, len(above) - 1
    score = above[0] + len(block)
    out = [score]
    for j, x in enumerate(columns):
        step = above[j + 1] - above[j] if j < last else 1
        equal = places.get(x, 0)
        vertical = equal | minus
        if step < 0:
            equal |= 1
        across = (((equal & plus) + plus) ^ plus) | equal
        rise = minus | (every & ~(across | plus))
        fall = plus & across
        if rise & bottom:
            score += 1
        elif fall & bottom:
            score -= 1
        out.append(score)
        rise, fall = rise << 1 & every, fall << 1 & every
        if step < 0:
            fall |= 1
        elif step > 0:
            rise |= 1
        plus = fall | (every & ~(vertical | rise))
        minus = rise & vertical
    return out


def _key(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))))


def _sketched(docs: DataFrame) -> DataFrame:
    """id, text hash and sketch of every row."""
    keyed = docs.select(_key().alias("id"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("same"), "text")

    def encode(kept, data, at):
        return [*kept, pa.array([s.tobytes() for s in sketch(data, at)], pa.binary())]

    return T.map_texts(keyed, ["id", "same"], "text", encode, "id long, same binary, sketch binary")


def _leaders(buckets: DataFrame) -> DataFrame:
    """(key, leader) of the buckets with two nodes or more.

    Adding 0 hides from the planner that the rows are dealt by key already: a join then has an exchange
    on both sides, and adaptive execution can split the partition of a hot bucket.
    """
    least = buckets.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("_last")).where("leader < _last")
    return least.select((F.col("key") + F.lit(0)).alias("key"), "leader")


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, leader, holds) for pairs of nodes, by alignment of their texts (node, text)."""
    whole = pairs.join(texts.withColumnRenamed("text", "a"), "node").join(texts.select(F.col("node").alias("leader"), F.col("text").alias("b")), "leader")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parsed = None, None
        for batch in batches:
            held = []
            for leader, a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if last != (leader, len(b or "")):
                    last, parsed = (leader, len(b or "")), (b or "").split()
                held.append(within((a or "").split(), parsed))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(held, pa.bool_())], names=["node", "leader", "holds"])

    return whole.select("node", "leader", "a", "b").mapInArrow(align, "node long, leader long, holds boolean")


def _nearest(pairs: DataFrame) -> DataFrame:
    """(node, leader): for every node of (node, leader, n) the leader of greatest n, then the least one."""
    return pairs.groupBy("node").agg(F.min_by("leader", F.struct(-F.col("n"), F.col("leader"))).alias("leader"))


def _roots(checked: DataFrame, files: int) -> DataFrame:
    """(node, root) of the classes that the pairs (node, leader, holds) make."""
    return keep(components(checked.where("holds").select("node", "leader")).coalesce(files))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (node, leader, ...) whose ends are in different classes."""
    top = roots.select(F.col("node").alias("leader"), F.col("root").alias("top"))
    return pairs.join(roots, "node", "left").join(top, "leader", "left").where("coalesce(root, node) != coalesce(top, leader)").select(*pairs.columns)


def _featured(texts: DataFrame) -> DataFrame:
    """node, text, number of words, bag of words and sketch of every row of (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in T.slices(batch.column(1)):
                node, text = (batch.column(k).slice(i, j - i) for k in (0, 1))
                words = [(t or "").split() for t in text.to_pylist()]  # the words that within() compares
                bags = [bag_of(w).tobytes() for w in words]
                columns = [node, text, pa.array([len(w) for w in words], pa.int64()), pa.array(bags, pa.binary()), pa.array([x.tobytes() for x in sketch(data, at)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "text", "size", "bag", "sketch"])

    return texts.select("node", "text").mapInArrow(run, "node long, text string, size long, bag binary, sketch binary")


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts of nodes, with what _featured adds, stored. The number of nodes grows with the corpus, so
    they are never sent to all tasks, at no size."""
    whole = docs.select(_key().alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    return keep(_featured(whole.join(nodes.hint("merge"), "node", "left_semi").dropDuplicates(["node", "text"])))


def bag_of(words: list[str]) -> np.ndarray:
    """How many words fall into each of BINS bins, 255 at most: differences of bags stay lower bounds."""
    bins = np.fromiter((zlib.crc32(w.encode()) % BINS for w in words), np.int64, len(words))
    return np.minimum(np.bincount(bins, minlength=BINS), 255).astype(np.uint8)


def possible(size: np.ndarray, bag: np.ndarray, root: np.ndarray, part: np.ndarray, guest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows from different roots that within() could accept, but for pairs of guests; of two
    parts, only pairs across."""
    order = np.argsort(size, kind="stable")
    size, bag, root, part, guest = size[order], bag[order].astype(np.int16), root[order], part[order], guest[order]
    two, left, right = part.min() != part.max(), [], []
    allowed = ((1 - SIMILARITY) * size + 1e-9).astype(np.int64)  # of the pair's longer text
    first = np.searchsorted(size, size - allowed)
    for k in range(1, len(size)):
        at = np.arange(first[k], k)
        at = at[(root[at] != root[k]) & ((part[at] != part[k]) | (not two)) & ~(guest[at] & guest[k])]
        if len(at):
            more = bag[k] - bag[at]
            over = np.maximum(more, 0).sum(1)
            at = at[np.maximum(over, over - more.sum(1)) <= allowed[k]]
            left.append(np.full(len(at), k))
            right.append(at)
    none = [np.zeros(0, np.int64)]
    return order[np.concatenate(left or none)], order[np.concatenate(right or none)]


def candidates_within(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of one pair of blocks that the bounds leave and that agree on an entry."""
    column = {c: group.column(c).to_numpy() for c in ("root", "part", "guest", "size")}
    table = lambda c, kind: np.frombuffer(T.buffers(group.column(c))[0].tobytes(), kind).reshape(len(group), -1)
    entries = table("sketch", np.int64)
    a, b = possible(column["size"], table("bag", np.uint8), column["root"], column["part"], column["guest"].astype(bool))
    meet = [(entries[a[k : k + (1 << 14)]] == entries[b[k : k + (1 << 14)]]).any(1) for k in range(0, len(a), 1 << 14)]
    chosen = np.concatenate(meet) if meet else np.zeros(0, bool)
    return a[chosen], b[chosen]


def links_within(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(node, leader) of links between different roots of one pair of blocks: enough of them to join all
    that are similar."""
    root, node = group.column("root").to_numpy(), group.column("node").to_numpy()
    a, b = candidates_within(group)
    words: dict[int, list] = {}
    above, out = {r: r for r in root.tolist()}, []

    def top(r: int) -> int:
        while above[r] != r:
            above[r] = above[above[r]]
            r = above[r]
        return r

    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(int(root[i])), top(int(root[j]))
        if p == q:
            continue
        for k in (i, j):
            if k not in words:
                words[k] = (group.column("text")[k].as_py() or "").split()
        if within(words[i], words[j]):
            above[p] = q
            out.append((i, j))
    x, y = (node[np.array(out, np.int64).reshape(-1, 2)[:, k]] for k in (0, 1))
    return np.maximum(x, y), np.minimum(x, y)


def band(size: Column) -> Column:
    """Bands of numbers of words: texts that within() accepts are in the same or in neighbouring bands."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(int(edges[-1] / SIMILARITY) + 1)  # above 1 / SIMILARITY times the edge before
    return F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= size))


def _paired(placed: DataFrame, groups: DataFrame, block: Column) -> DataFrame:
    """placed rows by pairs (low, high) of blocks of their group, each block as often as it meets another.
    Members of the group's class are in one class already: their blocks only meet the rest's."""
    of = lambda n: F.ceil(n / block)
    # adding 0 gives the join an exchange on both sides, as in _leaders
    groups = groups.select((F.col("main") + F.lit(0)).alias("main"), "cell", of(F.col("n_main")).alias("of_main"), of(F.col("n") - F.col("n_main")).alias("of_rest"))
    hashed, main = F.xxhash64("node"), F.col("root") == F.col("main")
    cut = placed.join(groups, ["main", "cell"])
    cut = cut.withColumn("part", F.when(main, F.pmod(hashed, "of_main")).otherwise(F.col("of_main") + F.pmod(hashed, "of_rest")))
    cut = cut.withColumn("other", F.explode(F.sequence(F.when(main, F.col("of_main")).otherwise(F.lit(0)), F.col("of_main") + F.col("of_rest") - 1)))
    return cut.select("main", "cell", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "guest", "node", "root", "size")


def _rest(buckets: DataFrame, mixed: DataFrame, roots: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, leader) of links between the classes that meet in the mixed buckets.

    A bucket falls into cells, one for each band of sizes. Cells of one class are done. Many of the others
    have the same largest class: they are one group, in which a node stands once, not once for each entry.
    Nodes travel as numbers up to there and meet their bags and sketches after that. In a group blocks meet
    by sizes, bags and sketches only, and the pairs that the bounds leave are aligned. Where they leave
    more than DENSE pairs a row (texts with like bags of words), no pairs are made: the group's texts meet in
    smaller blocks, and only links leave those tasks.
    """
    keys = buckets.join(mixed, "key", "left_semi").groupBy("node").agg(F.collect_set("key").alias("keys"))
    sized = texts.select("node", "size", band(F.col("size")).alias("band")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # the texts of a band meet each other and those of the next band (the guests)
    placed = keep(sized.join(keys, "node").withColumn("key", F.explode("keys")).select("key", "band", "node", "root", "size"))
    counts = placed.groupBy("key", "band", "root").agg(F.count("*").alias("n"))
    own, guests = (counts.select("key", (F.col("band") - g).alias("cell"), "root", "n", F.lit(bool(g)).alias("guest")) for g in (0, 1))
    counts = own.union(guests).groupBy("key", "cell", "root").agg(F.sum("n").alias("n"), F.min("guest").alias("guest"))
    cells = counts.groupBy("key", "cell").agg(F.count("*").alias("_roots"), F.min("guest").alias("_guest"), F.max(F.struct("n", "root")).alias("most"))
    cells = keep(cells.where("_roots > 1 AND NOT _guest").select((F.col("key") + F.lit(0)).alias("key"), "cell", F.col("most.root").alias("main")))
    own, guests = (placed.withColumn("cell", F.col("band") - g).join(cells, ["key", "cell"]).select("main", "cell", F.lit(bool(g)).alias("guest"), "node", "root", "size") for g in (0, 1))
    grouped = keep(own.union(guests).distinct())
    groups = keep(grouped.groupBy("main", "cell").agg(F.count("*").alias("n"), F.count_if(F.col("root") == F.col("main")).alias("n_main"), F.max("size").alias("size")))

    def meet(group: pa.Table) -> pa.Table:
        a, b = candidates_within(group)
        if len(a) > DENSE * len(group):
            return pa.table({"main": group.column("main")[:1], "cell": group.column("cell")[:1], "node": pa.nulls(1, pa.int64()), "leader": pa.nulls(1, pa.int64())})
        node = group.column("node").to_numpy()
        none = [group.column(c).take(pa.array(np.zeros(len(a), np.int64))) for c in ("main", "cell")]
        return pa.table({"main": none[0], "cell": none[1], "node": np.maximum(node[a], node[b]), "leader": np.minimum(node[a], node[b])})

    def link(group: pa.Table) -> pa.Table:
        node, leader = links_within(group)
        return pa.table({"node": node, "leader": leader})

    by = ("main", "cell", "low", "high")
    blocks = _paired(grouped, groups, F.lit(BLOCK)).join(texts.select("node", "bag", "sketch"), "node")
    found = keep(blocks.groupBy(*by).applyInArrow(meet, "main long, cell int, node long, leader long"))
    links = _verify(found.where("node IS NOT NULL").select("node", "leader").distinct(), texts).where("holds").select("node", "leader")
    dense = groups.join(found.where("node IS NULL").select("main", "cell").distinct(), ["main", "cell"], "left_semi")
    if not dense.limit(1).count():
        return links
    small = F.greatest(F.lit(1), F.least(F.lit(TEXT_BLOCK), F.floor(F.lit(BLOCK_WORDS) / F.col("size"))))
    whole = _paired(grouped, dense, small).join(texts.select("node", "bag", "sketch", "text"), "node")
    return links.unionByName(whole.groupBy(*by).applyInArrow(link, "node long, leader long")).distinct()


def classes(docs: DataFrame) -> DataFrame:
    """(id, class_id, rows) for every id: its class and the number of rows that share the id."""
    rows = keep(_sketched(docs))
    total = rows.count()
    files = 1 + total // FILE_ROWS  # tables of one row a document come in that many files
    # equal texts have one node and equal sketches
    copies = keep(rows.groupBy("same").agg(F.min("id").alias("node"), F.min("sketch").alias("sketch")).coalesce(1 + total // SKETCH_ROWS))
    # the first look: few entries, and of each node only the leader with which it shares most of them
    seeds = keep(_entries(copies.select("node", F.lit(None).cast("long").alias("root"), "sketch"), SEEDS).coalesce(SEEDS * files))
    met = seeds.join(_leaders(seeds), "key").where("node != leader")
    nearest = keep(_nearest(met.groupBy("node", "leader").agg(F.count("*").alias("n"))).coalesce(files))
    seen = nearest.select("node").union(nearest.select("leader")).distinct()
    begun = _texts(docs, seen)
    early = keep(_verify(nearest, begun).coalesce(files))
    # then all entries, in whose buckets one node stands for each class
    placed = copies.select("node", "sketch").join(_roots(early, files), "node", "left").select("node", "root", "sketch")
    buckets = keep(_entries(placed).coalesce(SAMPLES * files))
    grown = keep(buckets.where("root IS NOT NULL").groupBy("key", "root").agg(F.min("node").alias("node")).select("node", "key").coalesce(SAMPLES * files))
    standing = buckets.where("root IS NULL").select("node", "key").union(grown)
    met = keep(standing.join(_leaders(standing), "key").where("node != leader").coalesce(SAMPLES * files))
    pairs = keep(met.groupBy("node", "leader").agg(F.count("*").alias("n")).coalesce(files))
    # all that follows is about texts that share an entry with another class: they are shuffled once and stored
    more = pairs.select("node").union(pairs.select("leader")).distinct().join(seen.hint("merge"), "node", "left_anti")
    texts = begun.union(_texts(docs, more))
    fresh = keep(pairs.select("node", "leader").join(early, ["node", "leader"], "left_anti").coalesce(files))
    first = keep(early.union(_verify(fresh, texts)).repartition(SAMPLES * files))
    # the second chance: without the leaders that they don't resemble, the buckets' classes have other leaders
    roots = _roots(first, files)
    apart = _apart(first.where("NOT holds"), roots).select("node", "leader")
    unlike = keep(met.join(apart, ["node", "leader"], "left_semi").coalesce(SAMPLES * files))
    classed = unlike.join(roots, "node", "left").groupBy("key", F.coalesce("root", "node").alias("root")).agg(F.min("node").alias("node")).select("node", "key")
    again = classed.join(_leaders(classed), "key").where("node != leader").groupBy("node", "leader").agg(F.count("*").alias("n"))
    again = _nearest(again.join(first, ["node", "leader"], "left_anti"))
    second = _verify(keep(again.coalesce(files)), texts)
    done = keep(first.union(second).coalesce(SAMPLES * files))
    # all pairs of the buckets whose members are not in one class yet
    roots = _roots(done, files)
    apart = _apart(done.where("NOT holds"), roots)
    mixed = unlike.join(apart.select("node", "leader"), ["node", "leader"], "left_semi").select("key").distinct()
    third = keep(_rest(buckets.select("node", "key"), mixed, roots, texts))
    links = done.where("holds").select("node", "leader").union(third)
    # rows with one id but several texts are one document
    ids = rows.join(copies.select("same", "node"), "same").select("id", "node").distinct()
    roots = components(links.union(ids.where("id != node").select("id", "node")))
    found = rows.groupBy("id").agg(F.count("*").alias("rows"))
    return found.join(roots.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("root", "id").alias("class_id"), "rows")


def _entries(nodes: DataFrame, first: int = SAMPLES) -> DataFrame:
    """(node, root, key): a row for each of the `first` entries of a sketch; texts without a word have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = T.buffers(batch.column(2))
            keys = np.frombuffer(data.tobytes(), np.int64).reshape(-1, SAMPLES)[:, :first]
            there = np.flatnonzero(keys.ravel())
            rows = pa.array(there // first)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(keys.ravel()[there])], names=["node", "root", "key"])

    return nodes.mapInArrow(run, "node long, root long, key long")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, class_id of every row."""
    return docs.select("doc_id", _key().alias("id")).join(classes(docs), "id").select("doc_id", "class_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of docs for each class (that of its least id; of several such rows that of the least text)."""
    kept = keep(classes(docs).where("id = class_id").select(F.col("id").alias("_id"), F.col("rows").alias("_rows")))
    # the row travels as one struct, so its columns may have any names
    keyed = docs.select(_key().alias("_id"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    out = keyed.join(kept.where("_rows = 1"), "_id", "left_semi").select("row.*")
    if kept.where("_rows > 1").limit(1).count():
        line = Window.partitionBy("_id").orderBy("row.text", F.to_json("row"))
        several = keyed.join(kept.where("_rows > 1"), "_id", "left_semi").withColumn("_n", F.row_number().over(line))
        out = out.union(several.where("_n = 1").select("row.*"))
    return out
