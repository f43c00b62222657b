"""N-gram Jaccard join by a blocked sparse product.

A document's row of the incidence matrix is its set of distinct word shingles.
Documents with equal sets share a row. Two rows are linked when their overlap
is at least ``share`` of their union.

Which products are worked out: of the ``n - share * n + n / 8`` smallest
shingles (by hash) of two linked rows at least n / 8 are shared. A row in which
too few of these are found in any other row has no partner and is left out.
Of the others all shingles are counted, and a row meets those that share one
of its ``n - share * n + 1`` rarest: what many rows share, like a passage in
unlike documents, brings none of them together. Counts of rows by shingle are
taken in blocks of the hash range.

How the products are worked out: a block is one row, at most ``BLOCK`` rows
that meet it, and the overlaps are counted by a search of all their shingles in
the one row's. Pairs whose sizes alone rule a link out never get there.

First every row meets ``CENTRES`` centres for each of its rare shingles; then the
rows of one shingle meet all others that are not in the same component yet: pair
by pair, or where many rows meet, block by block. The components are those of all
links, but a link inside a component that other links hold together may never be
counted.

What is shuffled: hashes go once to the buckets of their range, and repeated ones
back to their row, 8 bytes each. A prefix is shuffled before that only if its set
has copies. Sets go to each step that works out products: all of them to the
centres, later only those that the step needs, if these are ``SMALL_IDS`` at most.

Defined results: NULL, empty and blank texts have no shingles and no links;
a text of fewer words than a shingle is one shingle; rows with equal ids are
one node, which has the links of all their texts; an empty table gives no rows.
Shingles are told apart by 48 bits inside a pair, copies of a set by 128 bits,
sets that meet by 64 of these. Sets meet by these, not by the ids of their rows;
links are between ids again when components are formed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import cache_of, modest_batches, table
from envstream.llm.components import components
from envstream.session import materialise, shared_dir

SIZE = 5
SHARE = (3, 4)
BLOCK = 256
#: Centres of a shingle.
CENTRES = 2
#: Shingles with more rows than this are worked off block by block, not pair by pair.
DENSE = 64
BUCKET_ENTRIES = 500_000
#: Rows of entries handed on at once.
STEP = 1 << 16
#: Ids of documents or sets that a step needs are sent to all tasks up to this many.
SMALL_IDS = 2_000_000
#: Bits of a shingle in a bucket; the rows that have it are counted in those above.
FP_BITS = 40
MOST_ROWS = (1 << 63 - FP_BITS) - 1
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_CACHE = 150_000
#: Stands for a NULL id, before all others.
NO_ID = -(2**63)
_U = np.uint64


class WordHash(dict):
    def __missing__(self, word):
        if len(self) > _CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value



def mix(h):
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def shingles(text, size=SIZE) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = cache_of("jaccard", WordHash)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        total = mix(total + h[j:len(h) - n + 1 + j])
    return np.unique(total)


def packed(hashes, width) -> bytes:
    """The upper ``width`` bytes of each."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(data, width):
    rows = np.frombuffer(data, np.uint8).reshape(-1, width)
    full = np.zeros((len(rows), 8), np.uint8)
    full[:, 8 - width:] = rows
    return full.view(">u8").reshape(-1).astype(np.uint64)


def node_of(digest):
    """What stands for a set where sets meet."""
    return int.from_bytes(digest[:8], "little", signed=True)


def needed(n, share=SHARE):
    """Least overlap of a set of n with any partner."""
    return -(-n * share[0] // share[1])


def shared_least(n):
    return n // 8 + 1


def prefix_length(n, share=SHARE):
    return min(n, n - needed(n, share) + shared_least(n))


def linked(overlap, n, m, share=SHARE):
    return overlap * share[1] >= share[0] * (n + m - overlap)


# --- rows -------------------------------------------------------------------


def _rows(share, size):
    def make(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                sets = [shingles(t, size) for t in part.column(1).to_pylist()]
                digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([node_of(d) for d in digests], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                    pa.array([packed(s[:prefix_length(len(s), share)], 5) for s in sets],
                             pa.binary()),
                ], names=["doc", "node", "n", "digest", "prefix"])

    return make


def _posted(n_buckets, width):
    """(doc, hashes) -> per bucket of the hash range: entries of many rows."""
    def post(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                yield entries(whole.slice(i, 1024))

    def entries(batch):
        docs, counts = batch.column(0).to_numpy(), []
        fps = [unpacked(p.as_py(), width) >> _U(8 * (width - 5)) for p in batch.column(1)]
        counts = np.array([len(f) for f in fps])
        owner, fps = np.repeat(np.arange(len(docs)), counts), np.concatenate(fps)
        bucket = ((fps >> _U(8)) * _U(n_buckets) >> _U(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        out = []
        for b in range(n_buckets):
            at = order[cuts[b]:cuts[b + 1]]
            if len(at):
                who, n = np.unique(owner[at], return_counts=True)
                out.append((b, packed(fps[at] << _U(24), 5), docs[who].tobytes(),
                            n.astype("<u4").tobytes()))
        return pa.RecordBatch.from_arrays([
            pa.array([o[0] for o in out], pa.int32()),
            *(pa.array([o[k] for o in out], pa.binary()) for k in (1, 2, 3)),
        ], names=["bucket", "fps", "docs", "counts"])

    return post


def _repeated(batches):
    """Entries sorted by bucket -> those whose shingle another row has, one row each, so
    that their number follows the entries and not the number of buckets."""
    held, current = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != current:
                if held:
                    yield from _of_bucket(held)
                held, current = [], row["bucket"]
            held.append(row)
    if held:
        yield from _of_bucket(held)


def _of_bucket(held):
    fps = np.concatenate([unpacked(r["fps"], 5) for r in held])
    docs = np.concatenate([
        np.repeat(np.frombuffer(r["docs"], np.int64), np.frombuffer(r["counts"], "<u4"))
        for r in held])
    order = np.argsort(fps, kind="stable")
    fps, docs = fps[order], docs[order]
    first = np.flatnonzero(np.concatenate([[True], fps[1:] != fps[:-1]])) if len(fps) else []
    runs = np.diff(np.append(first, len(fps)))
    df = np.repeat(runs, runs)
    kept = np.flatnonzero(df > 1)
    for i in range(0, len(kept), STEP):
        some = kept[i:i + STEP]
        # Sorted by these, shingles are sorted by their rows, rarest first.
        met = np.minimum(df[some], MOST_ROWS) << FP_BITS | fps[some].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs[some]), pa.array(met)], names=["doc", "met"])


def _first_screen(n, share):
    """Of how many of its repeated shingles a row needs the rarest: none, if too
    few of its prefix are repeated."""
    size = prefix_length(n, share)
    return size - shared_least(needed(n, share)) + 1, size


def _whole_row(n, share):
    return n - needed(n, share) + 1, n


def _meeting(share, bounds):
    """(doc, n, its entries) -> the shingles at which it meets others."""
    def pick(batches):
        for batch in batches:
            docs, out = batch.column(0).to_pylist(), []
            cuts, met = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy()
            for i, n in enumerate(batch.column(1).to_pylist()):
                own = np.sort(met[cuts[i]:cuts[i + 1]])
                wanted, size = bounds(n, share)
                most = wanted - (size - len(own))  # those of no other row come first
                out.append(own[:max(0, most)] & (1 << FP_BITS) - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), batch.column(1), pa.array(out, pa.list_(pa.int64()))],
                names=["doc", "n", "fps"])

    return pick


# --- products ---------------------------------------------------------------


def _sets(size):
    def make(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                sets = [shingles(t, size) for t in part.column(0).to_pylist()]
                nodes = [node_of(xxhash.xxh3_128_digest(s.tobytes())) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()),
                     pa.array([packed(s, 6) for s in sets], pa.binary())], names=["doc", "set"])

    return make


def _product(share):
    """One centre's row times the rows that meet it -> the linked ones."""
    def multiply(group):
        is_centre = group.column("b").to_pylist()
        sets = group.column("set").to_pylist()
        centre, a = None, group.column("a")[0].as_py()
        others = []
        for b, data in zip(is_centre, sets):
            if b is None:
                centre = unpacked(data, 6)
            else:
                others.append((b, data))
        found = []
        if centre is not None and others:
            rows = [unpacked(d, 6) for _, d in others]
            sizes = np.array([len(r) for r in rows])
            column = np.concatenate(rows)
            at = np.minimum(np.searchsorted(centre, column), len(centre) - 1)
            owner = np.repeat(np.arange(len(rows)), sizes)
            overlap = np.bincount(owner, centre[at] == column, len(rows)).astype(np.int64)
            good = linked(overlap, sizes, len(centre), share)
            found = [others[i][0] for i in np.flatnonzero(good)]
        return pa.table({"a": pa.array([a] * len(found), pa.int64()),
                         "b": pa.array(found, pa.int64())})

    return multiply


def _needed_sets(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The sets of these nodes if they are few, so that no others are shuffled; else all."""
    nodes = materialise(nodes.distinct())
    if nodes.count() > SMALL_IDS:
        return sets
    return sets.join(F.broadcast(nodes), "doc", "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame, share) -> DataFrame:
    """Pairs (a, b) that are links. Each block of partners gets its own copy of a's row."""
    blocks = F.ceil(F.count("*") / BLOCK).cast("int")
    sizes = pairs.groupBy("a").agg(blocks.alias("n_blocks"))
    dealt = pairs.join(sizes, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), "n_blocks").cast("int").alias("block"))
    rows = dealt.join(sets, dealt.b == sets.doc).select("a", "block", "b", "set")
    centres = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
                           .alias("block"))
    centres = centres.join(sets, centres.a == sets.doc).select(
        "a", "block", F.lit(None).cast("long").alias("b"), "set")
    return rows.unionByName(centres).groupBy("a", "block").applyInArrow(
        _product(share), "a long, b long")


def _fits(n, m, share):
    return f"least({n}, {m}) * {share[1]} >= greatest({n}, {m}) * {share[0]}"


def _stars(posts: DataFrame, share) -> DataFrame:
    """Every row with the centres of each of its shingles: linear in the rows."""
    centres = posts.groupBy("fp").agg(F.count("*").alias("rows"), *(
        F.min(F.struct((F.xxhash64("doc", F.lit(i)) if i else F.col("doc")).alias("k"), "doc", "n"))
        .alias(f"c{i}") for i in range(CENTRES)))
    centres = centres.where("rows > 1").select("fp", F.array_distinct(F.array(*(
        F.struct(f"c{i}.doc", f"c{i}.n") for i in range(CENTRES)))).alias("centres"))
    joined = posts.join(centres, "fp").select("doc", "n", F.explode("centres").alias("c"))
    joined = joined.where(f"doc <> c.doc and {_fits('n', 'c.n', share)}")
    return joined.select(F.least("doc", "c.doc").alias("a"),
                         F.greatest("doc", "c.doc").alias("b")).distinct()


def _open(posts: DataFrame, roots: DataFrame) -> DataFrame:
    """The entries of shingles whose rows are not all in one component yet."""
    placed = posts.join(roots.withColumnRenamed("node", "doc"), "doc", "left").select(
        "fp", "doc", "n", F.coalesce("root", "doc").alias("root"))
    mixed = placed.groupBy("fp").agg(
        F.min("root").alias("l"), F.max("root").alias("h"), F.count("*").alias("rows"))
    return placed.join(mixed.where("l < h").select("fp", "rows"), "fp")


def _across(entries: DataFrame, share) -> DataFrame:
    """All pairs that share a shingle and are not in one component yet."""
    pairs = entries.alias("x").join(entries.alias("y"), F.expr(
        f"x.fp = y.fp and x.root < y.root and {_fits('x.n', 'y.n', share)}"))
    return pairs.select(F.least("x.doc", "y.doc").alias("a"),
                        F.greatest("x.doc", "y.doc").alias("b")).distinct()


def _block_product(share):
    """Rows of two blocks (or of one) times each other -> links between components."""
    def multiply(group):
        docs, roots, left = (group.column(c).to_numpy() for c in ("doc", "root", "left"))
        rows = [unpacked(d, 6) for d in group.column("set").to_pylist()]
        sizes = np.array([len(r) for r in rows])
        ids = np.unique(np.concatenate(rows), return_inverse=True)[1]
        ends = np.cumsum(sizes)
        right = np.flatnonzero(~left) if not left.all() else np.arange(len(rows))
        column = np.concatenate([ids[ends[j] - sizes[j]:ends[j]] for j in right])
        starts = np.cumsum(sizes[right]) - sizes[right]
        mark, found = np.zeros(int(ids.max()) + 1, np.int32), []
        for i in np.flatnonzero(left):
            own = ids[ends[i] - sizes[i]:ends[i]]
            mark[own] = 1
            overlap = np.add.reduceat(mark[column], starts).astype(np.int64)
            mark[own] = 0
            good = linked(overlap, sizes[i], sizes[right], share) & (roots[right] != roots[i])
            found += [(min(docs[i], d), max(docs[i], d)) for d in docs[right[good]]]
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()),
                         "b": pa.array([f[1] for f in found], pa.int64())})

    return multiply


def _dense_links(entries: DataFrame, sets: DataFrame, share, block=BLOCK) -> DataFrame:
    """Links between components among rows that meet at crowded shingles.

    Rows that such shingles hold together are dealt to blocks: a large component
    has blocks of its own, the rows of small ones share blocks. Two blocks meet
    in one task, unless they are of one component. A row travels once for every
    block that its own meets, not once for every row.
    """
    rows = entries.select("doc", "root").distinct()
    first = entries.groupBy("fp").agg(F.min("doc").alias("a"))
    held = components(entries.join(first, "fp").select("a", F.col("doc").alias("b")))
    rows = rows.join(held.select(F.col("node").alias("doc"), F.col("root").alias("hub")), "doc")
    sizes = rows.groupBy("hub", "root").agg(F.count("*").alias("n"))
    rows = rows.join(sizes, ["hub", "root"]).withColumn(
        "side", F.when(F.col("n") >= block, F.col("root").cast("string")).otherwise("-"))
    totals = rows.groupBy("hub", "side").agg(F.ceil(F.count("*") / block).alias("n_blocks"))
    rows = rows.join(totals, ["hub", "side"]).withColumn(
        "block", F.concat_ws(":", "hub", "side", F.pmod(F.xxhash64("doc"), "n_blocks")))
    rows = materialise(rows.select("doc", "root", "hub", "side", "block"))
    sets = _needed_sets(sets, rows.select("doc"))
    blocks = rows.select("hub", "side", "block").distinct()
    pairs = blocks.alias("x").join(blocks.alias("y"), F.expr(
        "x.hub = y.hub and (x.block < y.block or x.block = y.block and x.side = '-') "
        "and (x.side <> y.side or x.side = '-')")).select(
        F.concat_ws("|", "x.block", "y.block").alias("pair"), F.col("x.block").alias("first"),
        F.col("y.block").alias("second"))
    sides = pairs.select("pair", F.col("first").alias("block"), F.lit(True).alias("left"))
    sides = sides.unionByName(pairs.where("first <> second").select(
        "pair", F.col("second").alias("block"), F.lit(False).alias("left")))
    sent = sides.join(rows, "block").join(sets, "doc").select(
        "pair", "doc", "root", "left", "set")
    return sent.groupBy("pair").applyInArrow(_block_product(share), "a long, b long")


def _met(rows: DataFrame, total, sizes: DataFrame, width, share, bounds) -> DataFrame:
    """(doc, hashes), ``total`` bytes of these -> doc, n, fps: the shingles at which each
    row meets others; rows that meet none are left out."""
    n_buckets = total // (width * BUCKET_ENTRIES) + 1
    posted = rows.mapInArrow(
        _posted(n_buckets, width), "bucket int, fps binary, docs binary, counts binary")
    repeated = posted.repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(
        _repeated, "doc long, met long")
    gathered = repeated.groupBy("doc").agg(F.collect_list("met").alias("met"))
    return gathered.join(sizes, "doc").select("doc", "n", "met").mapInArrow(
        _meeting(share, bounds), "doc long, n long, fps array<bigint>").where("size(fps) > 0")


def _sum(rows: DataFrame, value) -> int:
    return rows.agg(F.sum(value)).first()[0] or 0


def _prefixes(filled: DataFrame, again: DataFrame) -> DataFrame:
    """doc (what stands for the set) and prefix of every set once. Only those that more
    than one row has, ``again``, are shuffled, unless there are very many of them."""
    few, copied = again.count() <= SMALL_IDS, filled
    if few:
        copied = filled.join(F.broadcast(again), "node", "left_semi")
    once = copied.groupBy("digest").agg(
        F.first("node").alias("doc"), F.first("prefix").alias("prefix")).select("doc", "prefix")
    if not few:
        return once
    alone = filled.join(F.broadcast(again), "node", "left_anti")
    return alone.select(F.col("node").alias("doc"), "prefix").unionByName(once)


def clusters(docs: DataFrame, text="text", doc_id="doc_id", share=SHARE, size=SIZE,
             dense=DENSE) -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    spark = docs.sparkSession
    source = modest_batches(docs).select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.col(text).alias("text"))
    path = shared_dir(spark, "shingles")
    source.mapInArrow(_rows(share, size), "doc long, node long, n long, digest binary, prefix binary") \
        .write.parquet(path)
    rows = spark.read.parquet(path)
    filled = rows.where("n > 0")
    # From here to the links, ``doc`` is what stands for a set.
    nodes = materialise(filled.groupBy(F.col("node").alias("doc")).agg(
        F.max("n").alias("n"), F.count("*").alias("rows"),
        F.max(F.octet_length("prefix")).alias("bytes")))
    sizes = nodes.select("doc", "n")
    again = nodes.where("rows > 1").select(F.col("doc").alias("node"))
    screened = _met(_prefixes(filled, again), _sum(nodes, "bytes"), sizes, 5, share, _first_screen)
    ids = materialise(screened.select("doc"))
    named = filled.groupBy("node").agg(F.min("doc").alias("id"))
    named = materialise(named.join(ids, named.node == ids.doc).select("node", "id"))
    small = ids.count() <= SMALL_IDS
    few = named.select(F.col("id").alias("doc")).distinct()
    # Other texts of these ids come along and are left out by their sets.
    sets = source.join(F.broadcast(few) if small else few, "doc", "left_semi").select("text") \
        .mapInArrow(_sets(size), "doc long, set binary")
    sets = materialise(sets.join(F.broadcast(ids) if small else ids, "doc", "left_semi")
                       .dropDuplicates(["doc"]))
    met = _met(sets, _sum(sets, F.octet_length("set")), sizes, 6, share, _whole_row)
    posts = materialise(met.select("doc", "n", F.explode("fps").alias("fp")))
    tested = materialise(_stars(posts, share))
    links = materialise(_verified(tested, sets, share))
    entries = materialise(_open(posts, components(links)))
    pairs = _across(entries.where(F.col("rows") <= dense), share)
    pairs = materialise(pairs.join(tested, ["a", "b"], "left_anti"))
    needed = _needed_sets(sets, pairs.select(F.explode(F.array("a", "b")).alias("doc")))
    links = links.unionByName(materialise(_verified(pairs, needed, share)))
    crowded = entries.where(F.col("rows") > dense)
    if not crowded.isEmpty():
        links = links.unionByName(materialise(_dense_links(crowded, sets, share)))
    for end in ("a", "b"):
        links = links.join(named, links[end] == named.node).drop(end, "node") \
            .withColumnRenamed("id", end)
    links = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # Rows with one set hang together by their smallest document.
    firsts = filled.groupBy("digest").agg(F.min("doc").alias("a"))
    copies = filled.join(firsts, "digest").select("a", F.col("doc").alias("b")).where("a <> b")
    roots = components(links.unionByName(copies))
    named = rows.select("doc", "n").join(roots, rows.doc == roots.node, "left")
    return named.select(
        F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.nullif(F.coalesce("root", "doc"), F.lit(NO_ID)).alias("component_id"))


def first_of_each(docs: DataFrame, text="text", doc_id="doc_id", share=SHARE,
                  size=SIZE) -> DataFrame:
    """The rows whose id is the smallest of its component; equal rows once. Rows without
    an id cannot be told apart by it and stay, near copies among them too."""
    found = clusters(docs, text, doc_id, share, size).where(
        "doc_id is not null and doc_id <> coalesce(component_id, doc_id - 1)")
    dropped = materialise(found.select(F.col("doc_id").alias("_dropped")).distinct())
    few = F.broadcast(dropped) if dropped.count() <= SMALL_IDS else dropped
    kept = docs.join(few, docs[doc_id].cast("long") == few["_dropped"], "left_anti")
    return _once(kept, doc_id)


def _once(rows: DataFrame, doc_id) -> DataFrame:
    """Equal rows once. Only ids that come again are looked at closely."""
    again = materialise(rows.groupBy(F.col(doc_id).alias("_again")).count().where("count > 1")
                        .select("_again"))
    if again.isEmpty():
        return rows
    twice = rows.join(again, rows[doc_id].eqNullSafe(again["_again"]), "left_semi")
    alone = rows.join(again, rows[doc_id].eqNullSafe(again["_again"]), "left_anti")
    return alone.unionByName(twice.distinct())


def op9_ngram_jaccard(spark, sf_dir):
    return clusters(table(spark, sf_dir, "documents"))


def op9_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
with recursive words as (
  select doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{upper}', '{lower}'), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') as w from documents),
shingles as (
  select distinct doc_id, hash(array_to_string(w[i:i + 4], ' ')) as s
  from words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as t(i) where len(w) > 0),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as o
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select a, b from common join sizes x on a = x.doc_id join sizes y on b = y.doc_id
  where 100 * o >= 75 * (x.n + y.n - o)),
sides as (select a, b from links union all select b, a from links),
reached(node, root) as (
  select doc_id, doc_id from documents
  union select b, root from reached join sides on node = a where root < b)
select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, min(root) as component_id
from documents left join sizes using (doc_id) join reached on node = doc_id group by doc_id, n"""
