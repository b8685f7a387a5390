"""N-gram Jaccard join with grouped prefixes, and the components of its links.

A document's set are its distinct word shingles. Two sets x, y link when
100 * |x & y| >= percent * |x | y|. The join:

1. *Copies.* Equal sets are one node (128-bit hash of the set); copies inside a task drop
   their text before the first shuffle.
2. *Global order.* Texts are dealt into chunks by the set's hash. Each chunk sends its distinct
   shingles, sorted and packed, to buckets by hash range; a bucket sums how many chunks'
   nodes hold each and answers with the shared ones only. So a shingle of every document
   is one entry per chunk. Order: fewest nodes first, then by hash.
3. *Prefix.* Of n shingles in that order, the first n - ceil(percent * n) + 1 hold one that
   any linked set has in its own prefix. Nodes whose prefix holds only unshared shingles are done.
4. *Groups.* Nodes of equal prefix and equal size are one group; only groups meet through
   the shared prefix shingles, with size and positional filters.
5. *Verify.* First every node against the first of its group, and every group against two
   leaders of each of its shingles, in rounds (linear in the prefixes); what links is
   contracted into components. Then all remaining candidates whose nodes lie in different
   components are expanded to members and verified exactly, so no link between components
   is lost. Within a component links are not listed.

Shingles are 64-bit hashes. Null, empty and wordless texts have empty sets and link with
nothing; with fewer words than a shingle the whole sequence is the one shingle. Rows with
null keys are no nodes. Repeated rows are copies. Ties: a component is its smallest node. Very long
texts are taken whole; chunks are cut by shingles too. An empty table gives no rows. Other columns
are not read; ``keep_one`` returns all columns unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.common import distinct, drop_stored, mix64, own_names, parts_for, release, settle, stored, table, text_buffer, word_hashes, word_spans
from stratamart.llm.components import merged
from stratamart.llm.registry import query

WORDS = 4
PERCENT = 85
#: Documents and shingles of a chunk: bound the memory of a task, for short texts and for long ones.
CHUNK_DOCS = 2048
CHUNK_SHINGLES = 1 << 21
#: Rounds with leaders before the exact rest; they only save work.
LEADER_ROUNDS = 2
#: Prefixes of up to so many shared shingles travel with each of their entries. Pairs of longer ones are met at
#: each common shingle and made distinct afterwards; the result is the same.
PREFIX_SENT = 256
#: Bits of a shingle's hash that the global order uses; more shingles only blur the order, never the result.
ORDER_BITS = 52

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (uint64) of each whole text."""
    data, offsets = text_buffer(texts)
    data = _LOWER[data]
    starts, stops, owner = word_spans(data, offsets, _WORD)
    hashes = word_hashes(data, starts, stops)
    counts = np.bincount(owner, minlength=len(texts))
    begin = np.concatenate([[0], np.cumsum(counts)])
    rolled = mix64(hashes)
    for k in range(1, min(words, len(hashes))):
        rolled[:len(hashes) - k] = mix64(rolled[:len(hashes) - k] * np.uint64(0x9E3779B97F4A7C15) + hashes[k:])
    out = []
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        if b - a >= words:
            out.append(distinct(rolled[a:b - words + 1]))
        elif b > a:  # the whole sequence; its length keeps it apart from full shingles
            whole = np.array([b - a], np.uint64)
            for h in hashes[a:b]:
                whole = mix64(whole * np.uint64(0x9E3779B97F4A7C15) + h)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def needed(n, percent: int):
    """Smallest overlap of a set of n with any set it links with."""
    return -(-percent * n // 100)


def _mark(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted numbers as byte planes of their differences; Spark's shuffle compression removes the empty planes."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8")[:, 0], dtype=np.uint64)


def _rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def first_pass(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(id, mark, n, text): the set's size and hash of every row; the text only for the first row of a set in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                sets = shingle_sets(batch.column(1), words)
                marks = [_mark(s) for s in sets]
                keep = []
                for mark, s in zip(marks, sets):
                    keep.append(len(keep) if len(s) > 0 and mark not in seen else None)
                    seen.add(mark)
                texts = batch.column(1).take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(marks, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), texts], ["id", "mark", "n", "text"])

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, mark binary, n long, text string")


def _chunk_sets(table_: pa.Table, words: int) -> tuple[list[bytes], list[np.ndarray]]:
    """The distinct sets of a chunk in a fixed order."""
    marks = table_.column("mark").to_pylist()
    first = {}
    for i, mark in enumerate(marks):
        first.setdefault(mark, i)
    order = sorted(first)
    texts = table_.column("text").take(pa.array([first[m] for m in order], pa.int64())).combine_chunks()
    return order, shingle_sets(texts, words)


def prefixed(texts: DataFrame, chunks: int, words: int, percent: int) -> DataFrame:
    """Nodes with a shared shingle in their prefix.

    (mark, n, grp, tokens, places, shared): ``grp`` hashes size and prefix; ``tokens`` and
    ``places`` are the shared prefix shingles and where they stand in the order; ``shared`` packs
    all shingles that other nodes hold, too (the others cannot be in an intersection).
    """
    shift, buckets = np.uint64(64 - ORDER_BITS), chunks
    dealt = texts.select((F.pmod(F.xxhash64("mark"), F.lit(chunks))).cast("int").alias("chunk"), "mark", "text")

    def bucket_cuts(order: np.ndarray) -> np.ndarray:
        edges = [(i << ORDER_BITS) // buckets for i in range(buckets + 1)]
        return np.searchsorted(order, np.array(edges, np.uint64))

    def ask(group: pa.Table) -> pa.Table:
        _, sets = _chunk_sets(group, words)
        values, counts = np.unique(np.concatenate(sets) >> shift, return_counts=True)
        cuts = bucket_cuts(values).tolist()
        chunk = group.column("chunk")[0].as_py()
        some = [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        return pa.table({
            "bucket": pa.array([i for i, _, _ in some], pa.int32()), "chunk": pa.array([chunk] * len(some), pa.int32()),
            "packed": pa.array([pack_sorted(values[a:b]) for _, a, b in some], pa.binary()),
            "counts": pa.array([counts[a:b].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for _, a, b in some], pa.binary())})

    def answer(group: pa.Table) -> pa.Table:
        chunk = group.column("chunk").to_pylist()
        values = [unpack_sorted(x) for x in group.column("packed").to_pylist()]
        counts = [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(4, -1).T).view("<u4")[:, 0] for x in group.column("counts").to_pylist()]
        sizes = np.cumsum([len(v) for v in values])[:-1]
        _, at = np.unique(np.concatenate(values), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)[at]
        bucket = group.column("bucket")[0].as_py()
        shared = [(v[t > 1], t[t > 1]) for v, t in zip(values, np.split(total, sizes))]
        return pa.table({
            "chunk": pa.array(chunk, pa.int32()), "bucket": pa.array([bucket] * len(chunk), pa.int32()),
            "packed": pa.array([pack_sorted(v) for v, _ in shared], pa.binary()),
            "totals": pa.array([t.astype("<u4").tobytes() for _, t in shared], pa.binary())})

    def select(group: pa.Table, answers: pa.Table) -> pa.Table:
        out = {k: [] for k in ("mark", "n", "grp", "tokens", "places", "shared")}
        if group.num_rows:
            replies = sorted(zip(answers.column("bucket").to_pylist(), answers.column("packed").to_pylist(), answers.column("totals").to_pylist()))
            known = np.concatenate([np.zeros(0, np.uint64), *[unpack_sorted(p) for _, p, _ in replies]])
            total = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(t, "<u4") for _, _, t in replies]])
            for mark, shingles in zip(*_chunk_sets(group, words)):
                n = len(shingles)
                p = n - needed(n, percent) + 1
                short = shingles >> shift
                at = np.minimum(np.searchsorted(known, short), max(0, len(known) - 1))
                hit = known[at] == short if len(known) else np.zeros(n, bool)
                single = n - int(hit.sum())
                if single >= p:
                    continue
                held = shingles[hit]
                order = np.lexsort((held, short[hit], total[at[hit]]))[:p - single]
                prefix = held[order]
                grp = hashlib.blake2b(np.uint64(n).tobytes() + shingles[~hit].tobytes() + prefix.tobytes(), digest_size=16).digest()
                out["mark"].append(mark)
                out["n"].append(n)
                out["grp"].append(grp)
                out["tokens"].append(prefix.view(np.int64).tolist())
                out["places"].append(list(range(single, single + len(prefix))))
                out["shared"].append(held.tobytes())
        return pa.table({
            "mark": pa.array(out["mark"], pa.binary()), "n": pa.array(out["n"], pa.int64()), "grp": pa.array(out["grp"], pa.binary()),
            "tokens": pa.array(out["tokens"], pa.list_(pa.int64())), "places": pa.array(out["places"], pa.list_(pa.int32())),
            "shared": pa.array(out["shared"], pa.binary())})

    asked = dealt.groupBy("chunk").applyInArrow(ask, "bucket int, chunk int, packed binary, counts binary")
    answers = asked.groupBy("bucket").applyInArrow(answer, "chunk int, bucket int, packed binary, totals binary")
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        select, "mark binary, n long, grp binary, tokens array<long>, places array<int>, shared binary")


def verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of candidate pairs of marks that link."""
    sets = nodes.select("mark", "n", "shared")
    left, right = (sets.select(F.col("mark").alias(side), F.col("n").alias(f"n_{side}"), F.col("shared").alias(f"s_{side}")) for side in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, sa, nb, sb in zip(*(batch.column(c).to_pylist() for c in ("n_a", "s_a", "n_b", "s_b"))):
                x, y = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                keep.append(100 * common >= percent * (na + nb - common))
            rows = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([rows.column(rows.schema.get_field_index(c)) for c in "ab"], ["a", "b"])

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a binary, b binary")


def _size_fits(x: str, y: str, percent: int):
    return (F.col(x) * 100 >= F.col(y) * percent) & (F.col(y) * 100 >= F.col(x) * percent)


def _can_reach(a: str, b: str, percent: int):
    """Filters of a pair of groups that share a prefix shingle at places p.

    *Positional*: what precedes it in both, unshared shingles (the first s) aside, it, and what
    follows in both must reach the overlap that a link needs. *Count*: up to the last shingle of
    the prefix that ends first in the global order, common shingles lie in both prefixes; the
    rest of that set has needed(n) - 1. A pair passes at its first common shingle only.
    """
    na, nb, pa_, pb, sa, sb = (F.col(f"{c}_{side}") for c in "nps" for side in (a, b))
    most = F.least(pa_ - sa, pb - sb) + 1 + F.least(na - pa_ - 1, nb - pb - 1)
    both = F.array_intersect(f"sent_{a}", f"sent_{b}")
    rest = F.ceil(F.greatest(na, nb) * percent / 100) - 1
    counted = (F.get(both, F.lit(0)) == F.col("token")) & ((F.size(both) + rest) * (100 + percent) >= (na + nb) * percent)
    return (most * (100 + percent) >= (na + nb) * percent) & (F.col(f"sent_{a}").isNull() | F.col(f"sent_{b}").isNull() | counted)


def _leader_pairs(index: DataFrame, percent: int) -> DataFrame:
    """(grp, other): each group with the leader of each of its shingles in its size class and the next larger one.

    The leader is the group with the fewest unshared shingles: of near copies, the one closest to
    their origin. ``index`` has the group's component; groups of the leader's component
    are left out, and the first of those left leads the others.
    """
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    # The component stands behind the group, so it never decides the order.
    name = F.concat(F.lpad(F.col("s").cast("string"), 12, "0"), F.hex("grp"), F.col("comp").cast("string"))
    classed = index.select("grp", "comp", "token", size_class.alias("class"), name.alias("name"))
    # The first of each component; the first two of those are of different components.
    firsts = classed.groupBy("token", "class", "comp").agg(F.min("name").alias("name"))
    firsts = firsts.withColumn("at", F.row_number().over(Window.partitionBy("token", "class").orderBy("name"))).where("at <= 2")
    two = firsts.groupBy("token", "class").agg(F.min("name").alias("one"), F.max("name").alias("two"))
    leader = lambda c: F.struct(F.unhex(F.substring(c, 13, 32)).alias("grp"), F.substring(c, 45, 20).cast("long").alias("comp"))
    leaders = stored(two.select("token", "class", leader("one").alias("one"), leader("two").alias("two")), "jaccard-leaders")
    around = classed.select("grp", "comp", "token", F.explode(F.array(F.col("class"), F.col("class") + 1)).alias("class"))
    led = around.join(leaders, ["token", "class"]).where(F.col("comp") != F.col("one.comp"))
    led = led.select("grp", "comp", F.explode(F.array("one", "two")).alias("lead")).where(F.col("comp") != F.col("lead.comp"))
    pairs = stored(led.select("grp", F.col("lead.grp").alias("other")).distinct(), "jaccard-led")
    drop_stored(leaders)
    return pairs


def set_components(nodes: DataFrame, ids: DataFrame, percent: int) -> DataFrame | None:
    """(node, component) of every node that has a link. ``nodes`` has the columns of ``prefixed``, ``ids`` the (mark, node) that count."""
    spark = nodes.sparkSession
    small = nodes.select("mark", "grp", "n").join(ids, "mark")
    heads = small.groupBy("grp").agg(F.min(F.struct(F.hex("mark").alias("head"), "node")).alias("first"), F.max("n").alias("n"))
    heads = stored(heads.select("grp", F.unhex("first.head").alias("head"), "first.node", "n"), "jaccard-groups")
    # One entry for each group and shingle: the members' prefixes are equal. Long prefixes stay behind.
    sent = F.when(F.size("tokens") <= PREFIX_SENT, F.col("tokens"))
    index = nodes.join(heads.select("head", "node"), nodes["mark"] == heads["head"]).select(
        "grp", "node", "n", sent.alias("sent"), F.get("places", F.lit(0)).alias("s"), F.posexplode("tokens").alias("at", "token"), "places")
    index = stored(index.select("grp", "node", "n", "s", "sent", "token", F.get("places", F.col("at")).alias("p")), "jaccard-index")
    settle(spark)
    named = heads.select("grp", "head")

    def as_nodes(links: DataFrame) -> DataFrame:
        left, right = (ids.select(F.col("mark").alias(side), F.col("node").alias(f"{side}_node")) for side in "ab")
        return links.join(left, "a").join(right, "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))

    # Linear rounds: members with the first of their group, then groups with leaders.
    # Each step is written before the next one, so that no plan holds several of them.
    inside = small.join(named, "grp").where(F.col("mark") != F.col("head")).select(F.col("mark").alias("a"), F.col("head").alias("b"))
    links, comps = stored(as_nodes(verified(inside, nodes, percent)), "jaccard-links"), None
    for _ in range(LEADER_ROUNDS):
        placed = index.select("grp", "n", "s", "token", "node")
        placed = placed.withColumn("comp", F.col("node")) if comps is None else placed.join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node"))
        led = _leader_pairs(placed, percent)
        outer = led.join(named, "grp").withColumnRenamed("head", "a").join(named.select(F.col("grp").alias("other"), F.col("head").alias("b")), "other")
        swap = F.col("a") > F.col("b")
        outer = outer.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b")).distinct()
        found = stored(as_nodes(verified(outer, nodes, percent)), "jaccard-links")
        drop_stored(led)
        comps = merged(comps, found if links is None else links.unionByName(found))
        release(spark, [f.scratch for f in (found, links) if f is not None])
        links = None

    # The rest: entries of a shingle whose nodes lie in several components.
    placed = small.withColumn("comp", F.col("node")) if comps is None else small.join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node"))
    placed = placed.select("grp", "mark", "comp")
    placed = stored(placed, "jaccard-placed")
    parts = index.drop("node").join(placed.select("grp", "comp").distinct(), "grp")
    mixed = parts.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("token")
    parts = stored(parts.join(mixed, "token", "left_semi"), "jaccard-rest")
    side = lambda x: parts.select("token", *[F.col(c).alias(f"{c}_{x}") for c in ("grp", "n", "s", "p", "comp", "sent")])
    settle(spark)
    rest = (
        side("x").join(side("y"), "token").where((F.col("comp_x") < F.col("comp_y")) & _size_fits("n_x", "n_y", percent) & _can_reach("x", "y", percent))
        .select("grp_x", "comp_x", "grp_y", "comp_y").distinct()
    )
    rest = stored(rest, "jaccard-pairs")
    release(spark, [index.scratch, parts.scratch])
    member = lambda x, c: placed.select(F.col("grp").alias(f"grp_{x}"), F.col("comp").alias(f"comp_{x}"), F.col("mark").alias(c))
    pairs = rest.join(member("x", "a"), ["grp_x", "comp_x"]).join(member("y", "b"), ["grp_y", "comp_y"]).select("a", "b")
    found = stored(as_nodes(verified(pairs, nodes, percent)), "jaccard-links")
    comps = merged(comps, found)
    release(spark, [f.scratch for f in (found, rest, placed, heads)])
    return comps


def _sets(docs: DataFrame, key: str, text: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(id, mark, n) of every row, and the nodes of ``prefixed``; every text is shingled once for both and once more in its chunk."""
    seen = stored(first_pass(docs, key, text, words).withColumn("first", F.col("text").isNotNull()), "jaccard-first", "zstd")
    rows = stored(seen.select("id", "mark", "n"), "jaccard-rows")
    size = seen.where("first").agg(F.count(F.lit(1)), F.sum("n")).first()
    chunks = max(parts_for(size[0], CHUNK_DOCS), parts_for(size[1] or 0, CHUNK_SHINGLES))
    nodes = stored(prefixed(seen.where("first"), chunks, words, percent), "jaccard-prefixes")
    drop_stored(seen)
    return rows, nodes


def _placed(sets: DataFrame, comps: DataFrame | None) -> DataFrame:
    """``sets`` with the component of their node."""
    if comps is None:
        return sets.withColumn("component", F.col("node"))
    return sets.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))


def similarity_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) of every row; the component is the smallest key reachable by links."""
    rows, nodes = _sets(docs, key, text, words, percent)
    sets = stored(rows.where("n > 0 and id is not null").groupBy("mark").agg(F.min("id").alias("node")), "jaccard-sets")
    comps = set_components(nodes, sets, percent)
    drop_stored(nodes)
    placed = _placed(sets, comps).select("mark", F.col("component").alias("component_id"))
    # A hot set is split by Spark's skew join; rows without a set stand alone.
    joined = rows.join(placed, "mark", "left")
    own = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return joined.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"))


def _with_marks(docs: DataFrame, words: int, name: str) -> DataFrame:
    columns = docs.columns
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                marks = [_mark(s) for s in shingle_sets(batch.column(at), words)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.binary())], [*columns, name])

    return docs.mapInArrow(run, docs.withColumn(name, F.lit(b"")).schema)


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of sets: the one of the smallest doc_id, then of the smallest text.

    Sets are the nodes here, so rows of one doc_id whose texts do not link stay apart. Wordless rows
    of one doc_id are one. Rows with null ids stay; columns unchanged.
    """
    rows, nodes = _sets(docs, "doc_id", "text", words, percent)
    rows = rows.where("id is not null")
    # Several sets can share their smallest id, so each has a number of its own; written once, as numbers may not change.
    sets = rows.where("n > 0").groupBy("mark").agg(F.min("id").alias("id"))
    sets = stored(sets.withColumn("node", F.monotonically_increasing_id()), "kept-sets")
    comps = set_components(nodes, sets.select("mark", "node"), percent)
    drop_stored(nodes)
    placed = stored(_placed(sets, comps).select("mark", "id", "component"), "kept-placed")
    first = placed.groupBy("component").agg(F.min("id").alias("id"))
    # The sets that hold their component's smallest id; wordless rows have no component.
    chosen = placed.join(first, ["component", "id"]).select("id", "mark", "component")
    empty = rows.where("n = 0").select("id", "mark", F.lit(None).cast("long").alias("component")).distinct()
    kept = stored(chosen.unionByName(empty), "kept-documents")
    repeated = stored(rows.groupBy("id").count().where("count > 1").select(F.col("id").alias("doc_id")), "repeated-ids")
    single = docs.join(kept.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    out = docs.where(F.col("doc_id").isNull()).select(*[f"`{c}`" for c in docs.columns])
    if repeated.isEmpty():
        return single.select(*[f"`{c}`" for c in docs.columns]).unionByName(out)
    single = single.join(repeated, "doc_id", "left_anti")
    # Rows of an id that occurs more than once: each is told by its set, ties by its text.
    mark, group, least = own_names(docs, "mark", "group", "least")
    several = _with_marks(docs.join(repeated, "doc_id", "left_semi").select(*[f"`{c}`" for c in docs.columns]), words, mark)
    several = several.join(kept.select(F.col("id").alias("doc_id"), F.col("mark").alias(mark), F.col("component").alias(group)), ["doc_id", mark])
    several = stored(several.withColumn(group, F.coalesce(F.col(group), F.lit(-1))), "kept-several")
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    smallest = several.groupBy("doc_id", group).agg(F.min(body).alias(least))
    several = several.join(smallest, ["doc_id", group]).where(body == F.col(least)).dropDuplicates(["doc_id", group])
    return single.select(*[f"`{c}`" for c in docs.columns]).unionByName(several.select(*[f"`{c}`" for c in docs.columns])).unionByName(out)


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words
), tokens AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT l.y, r.c FROM reach r JOIN links l ON l.x = r.doc_id
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, (SELECT min(c) FROM reach r WHERE r.doc_id = s.doc_id) AS component_id FROM sets s
"""


@query(SQL)
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Set size and component of every document."""
    return similarity_components(table(spark, folder, "documents"))
