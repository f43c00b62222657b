"""Conversations as a z-fast trie over turns.

A conversation is a sequence of turns, and a prefix of it is known by a hash of
128 bits: the exclusive or of the hashes of (place, turn). The trie is compacted;
its nodes are the root, the ends of conversations and the places where they part.
A node covers the depths from below its parent's depth ``low`` to its own depth
``high`` and is kept in a table under its handle, the hash of its prefix at the
two-fattest depth of that stretch (the one that most powers of two divide).

Equal conversations are worked off once. Each batch looks for the exit of every
conversation not yet in the trie by fat binary search: the two-fattest depth of
the interval is looked up in the table of handles, which halves the interval.
A last look-up, by the prefix one turn longer, finds the edge on which the
conversation leaves, and the hashes along the edge say where. Conversations that
end on an edge, or part from it, split it; of those that leave at one place with
one turn, a single one, drawn by hash, is inserted as a leaf, and the others go
on in the next batch. A group halves from batch to batch on average, so there
are about as many batches as its size has binary digits, and fewer where the trie
is shallow; a conversation takes as many look-ups as its length has digits.

Sums over subtrees are made by doubling: in step k, each node adds what the nodes
2^k levels below it hold, so a trie of height h takes log h joins. Edges are
expanded into one row per depth last. Nodes are sent to the tasks while there are
at most ``MOST_NODES`` of them; beyond that the look-ups are shuffled joins, which
adaptive execution splits at hot prefixes.

Defined results: NULL roles and texts are empty; turns are ordered by turn (NULL
first), then role, then the text's hash; repeated rows are turns of their own;
rows without conv_id belong to no conversation; other columns are not read. An
empty table has no nodes. A conversation's hashes (24 bytes a turn) are one value,
its texts are not.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import table, words_of
from envstream.session import materialise

MOST_NODES = 200_000
#: Conversation ids of one end are joined in lots of 2^LOT_BITS neighbouring ids.
LOT_BITS = 12


def sequences(turns: DataFrame, conv="conv_id", turn="turn", role="role",
              text="text") -> DataFrame:
    """One row per conversation: conv_id, turns (turn, role, a, b, n_words)."""
    who, what = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), who.alias("role"),
                 F.xxhash64(F.lit(1), who, what).alias("a"),
                 F.xxhash64(F.lit(2), who, what).alias("b"),
                 F.size(words_of(F.col(text))).cast("long").alias("n_words")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def _prefixes(batches):
    """Hashes and word counts of all prefixes, the empty one first."""
    for batch in batches:
        turns = batch.column("turns")
        offsets = turns.offsets.to_numpy()
        n = np.diff(offsets)
        flat = turns.values.slice(offsets[0], offsets[-1] - offsets[0])
        first = np.repeat(offsets[:-1] - offsets[0], n)
        place = (np.arange(len(flat)) - first).astype(np.uint64)
        columns = []
        for name, odd in (("a", 0x9E3779B97F4A7C15), ("b", 0xC2B2AE3D27D4EB4F)):
            values = np.asarray(flat.field(name)).view(np.uint64)
            columns.append(_running(_mixed(values, place, odd), n, np.bitwise_xor).view(np.int64))
        columns.append(_running(np.asarray(flat.field("n_words")), n, np.add))
        bounds = pa.array(np.concatenate([[0], np.cumsum(n + 1)]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(n, pa.int32())]
            + [pa.ListArray.from_arrays(bounds, pa.array(c, pa.int64())) for c in columns],
            names=["conv_id", "n", "a", "b", "words"])


def _mixed(values, place, odd):
    """A turn's hash at a place, spread over all bits."""
    with np.errstate(over="ignore"):
        x = values ^ (place + np.uint64(1)) * np.uint64(odd)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _running(values, n, add):
    """Running ``add`` within rows of ``n`` values each, with a zero before each row."""
    padded = np.zeros(len(values) + len(n), values.dtype)
    starts = np.cumsum(n + 1) - (n + 1)
    inside = np.ones(len(padded), bool)
    inside[starts] = False
    padded[inside] = values
    total = add.accumulate(padded) if len(padded) else padded
    before = np.repeat(total[starts], n + 1)
    return total ^ before if add is np.bitwise_xor else total - before


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, turns) -> conv_id, n, and for prefixes of 0 to n turns the two
    halves of their hash, ``a`` and ``b``, and the words in them."""
    return rows.select("conv_id", "turns").mapInArrow(
        _prefixes, "conv_id long, n int, a array<long>, b array<long>, words array<long>")


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    digits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, digits), digits)


class Trie:
    """The compacted nodes: low, high, the prefix hash at low (pa, pb), one turn below
    (fa, fb), at the handle (ha, hb) and at high (a, b), the hashes along the edge,
    and a conversation that passes."""

    def __init__(self, most_nodes=MOST_NODES):
        self.most_nodes = most_nodes
        self.nodes = None
        self.small = True

    def add(self, nodes):
        self.nodes = materialise(nodes)
        self.small = self.nodes.count() <= self.most_nodes

    def lookup(self, columns):
        found = self.nodes.select(*columns)
        return F.broadcast(found) if self.small else found


def _node(rows: DataFrame) -> DataFrame:
    """low, high, conv_id and the hashes along a conversation -> a node."""
    at = {"p": F.col("low"), "f": F.col("low") + 1, "": F.col("high"),
          "h": two_fattest(F.col("low"), F.col("high"))}
    hashes = [F.get(f"all_{half}", place).alias(name + half)
              for name, place in at.items() for half in ("a", "b")]
    edge = F.transform(
        F.sequence(F.col("low") + 1, F.col("high")),
        lambda d: F.struct(F.get("all_a", d).alias("a"), F.get("all_b", d).alias("b")))
    return rows.select("low", "high", "conv_id", at["h"].alias("handle"), *hashes,
                       edge.alias("edge"))


def _split(nodes: DataFrame, cuts: DataFrame) -> DataFrame:
    """Edges cut at the depths ``cuts`` (a, b, high, cut) names."""
    places = cuts.groupBy("a", "b", "high").agg(F.array_sort(F.collect_set("cut")).alias("cuts"))
    joined = nodes.join(places, ["a", "b", "high"], "left")
    same = joined.where("cuts is null").select(*nodes.columns)
    # The edge's hashes stand at their depths again, so that the pieces can be made alike.
    before = F.struct(F.col("pa").alias("a"), F.col("pb").alias("b"))
    along = F.concat(F.array_repeat(before, F.col("low") + 1), "edge")
    lows = F.concat(F.array("low"), "cuts")
    highs = F.concat("cuts", F.array("high"))
    piece = F.transform(highs, lambda high, i: F.struct(
        F.get(lows, i).alias("low"), high.alias("high")))
    pieces = joined.where("cuts is not null").select(
        "conv_id", along.alias("along"), F.explode(piece).alias("piece"))
    pieces = pieces.select("conv_id", "piece.low", "piece.high",
                           F.col("along.a").alias("all_a"), F.col("along.b").alias("all_b"))
    return same.unionByName(_node(pieces))


def _exits(active: DataFrame, trie: Trie, longest: int) -> DataFrame:
    """Adds to conversations: ``low`` (the deepest node that is wholly a prefix),
    ``cut`` (turns shared with the trie) and the edge they leave on (ea, eb, end;
    NULL where they leave at the node itself)."""
    kept = [F.col(c) for c in active.columns]
    low, high, handle = F.col("low"), F.col("high"), F.col("handle")
    to_low, to_high = F.col("to_low"), F.col("to_high")
    probe = F.when(low < high, two_fattest(low, high))
    known = trie.lookup(["handle", "ha", "hb", low.alias("to_low"), high.alias("to_high"),
                         F.col("a").alias("ta"), F.col("b").alias("tb")])
    probed = [*kept, low, high, probe.alias("handle"),
              F.get("a", probe).alias("ha"), F.get("b", probe).alias("hb")]
    whole = F.coalesce((F.get("a", to_high) == F.col("ta")) & (F.get("b", to_high) == F.col("tb")),
                       F.lit(False))
    # A handle that meets while the node's end does not: the exit is on its edge.
    narrowed = [
        *kept, F.when(whole, to_high).otherwise(F.coalesce(to_low, low)).alias("low"),
        F.when(whole, high).otherwise(F.coalesce(to_low, handle - 1, high)).alias("high")]
    rows = active.select(*kept, F.lit(0).alias("low"), F.col("n").alias("high"))
    for _ in range(max(1, longest).bit_length()):
        rows = rows.select(*probed).join(known, ["handle", "ha", "hb"], "left").select(*narrowed)
    rows = rows.select(*kept, low, F.get("a", low + 1).alias("fa"), F.get("b", low + 1).alias("fb"))
    edges = trie.lookup(["low", "fa", "fb", F.col("a").alias("ea"), F.col("b").alias("eb"),
                         high.alias("end"), "edge"])
    rows = rows.join(edges, ["low", "fa", "fb"], "left")
    shared = F.size(F.filter("edge", lambda e, i: (e.a == F.get("a", F.col("low") + i + 1))
                             & (e.b == F.get("b", F.col("low") + i + 1))))
    return rows.withColumn("cut", F.col("low") + F.when(
        F.col("end").isNull(), 0).otherwise(shared)).drop("fa", "fb", "edge")


def build(strings: DataFrame, most_nodes=MOST_NODES) -> Trie:
    """The trie of different conversations (conv_id, n, a, b)."""
    trie = Trie(most_nodes)
    active = strings.where("n > 0").select("conv_id", "n", "a", "b")
    longest = active.agg(F.max("n")).first()[0] or 0
    columns = active.columns
    trie.add(_node(active.where("false").select(
        F.lit(0).alias("low"), F.col("n").alias("high"), "conv_id",
        F.col("a").alias("all_a"), F.col("b").alias("all_b"))))
    active = materialise(active)
    while not active.isEmpty():
        left = materialise(_exits(active, trie, longest))
        first = F.col("cut") + 1
        outside = left.where("cut < n")
        chosen = materialise(outside.groupBy(F.get("a", first), F.get("b", first), "cut").agg(
            F.min(F.struct(F.xxhash64("conv_id").alias("h"), "conv_id")).alias("drawn")
        ).select("drawn.conv_id"))
        leaves = _node(outside.join(chosen, "conv_id", "left_semi").select(
            F.col("cut").alias("low"), F.col("n").alias("high"), "conv_id",
            F.col("a").alias("all_a"), F.col("b").alias("all_b")))
        cuts = left.where("end is not null and cut < end").select(
            F.col("ea").alias("a"), F.col("eb").alias("b"), F.col("end").alias("high"), "cut")
        trie.add(_split(trie.nodes, cuts.distinct()).unionByName(leaves))
        active = materialise(outside.join(chosen, "conv_id", "left_anti").select(*columns))
    return trie


def _summed(nodes: DataFrame, sums) -> DataFrame:
    """Adds up ``sums`` (column -> aggregate) over subtrees; a node is (id, up)."""
    nodes = materialise(nodes)
    while not nodes.where("up is not null").isEmpty():
        below = nodes.where("up is not null").groupBy(F.col("up").alias("id")).agg(
            *(how(c).alias(f"more_{c}") for c, (how, _) in sums.items()))
        above = nodes.select(F.col("id").alias("up"), F.col("up").alias("further"))
        joined = nodes.join(below, "id", "left").join(above, "up", "left")
        nodes = materialise(joined.select(
            "id", F.col("further").alias("up"),
            *(both(F.col(c), F.coalesce(F.col(f"more_{c}"), F.col(c) if how is F.min else F.lit(0)))
              .alias(c) for c, (how, both) in sums.items()),
            *(c for c in nodes.columns if c not in ("id", "up", *sums))))
    return nodes.drop("up")


def _digests(batches):
    """Sorted lots (id, lot, ids) of whole ends -> one SHA-256 per end, in one pass."""
    last, state, out = None, None, []
    for batch in batches:
        for key, ids in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
            if key != last:
                if last is not None:
                    out.append((last, state.hexdigest()))
                last, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(out) >= 10_000:
            yield _digest_rows(out)
            out = []
    if last is not None:
        out.append((last, state.hexdigest()))
    if out:
        yield _digest_rows(out)


def _digest_rows(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())],
        names=["id", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(id, conv_id) -> the digest of each end's ids in ascending order. Lots are
    joined side by side; one task holds one lot at a time."""
    lot = F.shiftright("conv_id", LOT_BITS)
    lots = ends.groupBy("id", lot.alias("lot")).agg(F.array_join(
        F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ","
    ).alias("ids"))
    return lots.repartition("id").sortWithinPartitions("id", "lot").mapInArrow(
        _digests, "id string, ends_sha256 string")


def _name(depth, a, b):
    """One value for a node: its depth and both halves of its hash."""
    return F.concat_ws(":", depth, a, b)


def nodes(rows: DataFrame, most_nodes=MOST_NODES) -> DataFrame:
    """One row per node of the trie of ``rows`` (conv_id, turns), as ``op12`` returns."""
    every = materialise(prefixes(rows))
    last = [F.get(c, F.col("n")) for c in ("a", "b")]
    named = every.withColumn("id", _name(F.col("n"), *last))
    groups = materialise(named.groupBy("id").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("copies")))
    strings = materialise(every.join(groups, "conv_id"))
    trie = build(strings, most_nodes)
    compact = trie.nodes.select(
        _name("high", "a", "b").alias("id"), _name("low", "pa", "pb").alias("up"), "low", "high",
        F.col("conv_id").alias("passing"))
    top = every.limit(1).select(  # the root, if there is a conversation at all
        F.lit("0:0:0").alias("id"), F.lit(None).cast("string").alias("up"),
        F.lit(-1).alias("low"), F.lit(0).alias("high"), F.lit(None).cast("long").alias("passing"))
    compact = compact.unionByName(top)
    ends = strings.select(
        "id", "conv_id", "copies", (F.col("copies") * F.get("words", F.col("n"))).alias("weighted"))
    along = strings.select(F.col("conv_id").alias("passing"), F.col("words").alias("words_to"))
    children = compact.groupBy(F.col("up").alias("id")).agg(F.count("*").alias("children"))
    whole = compact.join(ends, "id", "left").join(children, "id", "left").join(
        along, "passing", "left")
    zero = F.lit(0).cast("long")
    whole = whole.select(
        "id", "up", F.col("up").alias("parent"), "low", "high", "words_to",
        F.coalesce("children", zero).alias("children"), "conv_id",
        F.coalesce("copies", zero).alias("n_convs"), F.coalesce("weighted", zero).alias("weighted"),
        F.coalesce(F.get("words_to", F.col("high")) - F.get("words_to", F.col("low")), zero).alias(
            "edge_words"),
        F.when(F.col("children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"))
    total = (F.sum, lambda x, y: x + y)
    summed = _summed(whole, {
        "conv_id": (F.min, lambda x, y: F.least(x, y)), "n_convs": total, "weighted": total,
        "edge_words": total, "n_leaves": total})
    summed = materialise(summed)
    above = summed.select(F.col("id").alias("parent"), F.col("conv_id").alias("above"))
    digests = end_digests(named.select("id", "conv_id"))
    full = summed.join(above, "parent", "left").join(digests, "id", "left")
    # One row per depth of an edge; an end or a parting is at its last depth only.
    out = full.withColumn("depth", F.explode(F.sequence(F.col("low") + 1, F.col("high"))))
    at_end = F.col("depth") == F.col("high")
    before = F.coalesce(F.get("words_to", F.col("depth") - 1), zero)
    start = F.coalesce(F.get("words_to", F.col("low")), zero)
    # Words below, once for each conversation, less once for the turns themselves.
    saved = (F.col("weighted") - F.col("n_convs") * before
             - (F.col("edge_words") - (before - start)))
    return out.select(
        "conv_id", F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") == 0, F.lit(None).cast("long")).when(F.col("depth") == F.col("low") + 1, F.col("above"))
        .otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(at_end, F.col("children")).otherwise(F.lit(1).cast("long")).alias("n_children"), "n_leaves",
        saved.alias("saved_tokens"),
        F.when(at_end & F.col("ends_sha256").isNotNull(), F.col("ends_sha256")).otherwise(
            F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def rebuilt(rows: DataFrame, step=20) -> DataFrame:
    """Each conversation c with its first h turns taken from conversation c - c % step,
    h = crc32(c) % 4. At most ``step`` conversations share a head."""
    heads = rows.select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int")
    joined = rows.select("*", (F.col("conv_id") - F.col("conv_id") % step).alias("base"),
                         h.alias("h")).join(heads, "base", "left")
    own = F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")
    head = F.expr("slice(coalesce(head, slice(turns, 1, 0)), 1, h)")
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def op12_conversation_prefix_trie(spark, sf_dir):
    return nodes(rebuilt(sequences(table(spark, sf_dir, "conversations"))))


def op12_sql() -> str:
    words = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"
    return f"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, role, text) as k
  from conversations where conv_id is not null),
convs as (select distinct conv_id from turns),
crc as (
  select list(list_reduce(range(8), lambda c, i:
    case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b) order by b) as t
  from range(256) as r(b)),
hs as (
  select conv_id, xor(list_reduce(
    list_transform(string_split(cast(conv_id as varchar), ''), lambda s: cast(ascii(s) as bigint)),
    lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295), 4294967295) % 4 as h
  from convs, crc),
heads as (
  select c.conv_id, h, count(t.k) as m
  from hs c left join turns t on t.conv_id = c.conv_id - c.conv_id % 20 and t.k <= c.h
  group by c.conv_id, h),
rebuilt as (
  select h.conv_id, t.k as d, role, text
  from heads h join turns t on t.conv_id = h.conv_id - h.conv_id % 20 and t.k <= h.h
  union all
  select h.conv_id, h.m + t.k - h.h as d, role, text
  from heads h join turns t on t.conv_id = h.conv_id and t.k > h.h),
paths as (
  select conv_id, d, {words} as n_words,
    sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
      over (partition by conv_id order by d rows unbounded preceding)) as path
  from rebuilt
  union all select conv_id, 0, 0, '' from convs),
lengths as (select conv_id, max(d) as n from paths group by conv_id),
found as (
  select d, path, min(p.conv_id) as conv_id, count(*) as n_convs, any_value(n_words) as n_words,
    sha256(coalesce(string_agg(cast(p.conv_id as varchar), ',' order by p.conv_id)
      filter (where n = d), '')) as ends_sha256
  from paths p join lengths using (conv_id) group by d, path),
kids as (
  select q.d - 1 as d, p.path, count(*) as n_children
  from found q join paths p on p.conv_id = q.conv_id and p.d = q.d - 1 group by q.d, p.path),
below as (
  select p.d, p.path, sum((q.n_convs - 1) * q.n_words) as saved_tokens,
    count(*) filter (where k.n_children is null) as n_leaves
  from found q join paths p on p.conv_id = q.conv_id and p.d <= q.d
    left join kids k on k.d = q.d and k.path = q.path
  group by p.d, p.path)
select f.conv_id, f.d as depth, up.conv_id as parent_conv_id, f.n_convs,
  coalesce(k.n_children, 0) as n_children, b.n_leaves,
  cast(b.saved_tokens as bigint) as saved_tokens, f.ends_sha256
from found f join below b using (d, path) left join kids k using (d, path)
  left join paths pp on pp.conv_id = f.conv_id and pp.d = f.d - 1
  left join found up on up.d = pp.d and up.path = pp.path"""
