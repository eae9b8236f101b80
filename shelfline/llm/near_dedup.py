"""Near duplicates: MinHash signatures joined by coordinate, links confirmed on whole shingle sets.

Each class of equal shingle sets is posted under its signature's (coordinate, value) pairs. Two sets of
the similarity sought agree in at least `least` coordinates but for odds of about one in a hundred
million, so each class is only posted under its rarest values (the prefix: all but `least` - 1 of
them), and the long lists of the rest are skipped: collisions in them are counted by comparing
signatures. Lists are not multiplied out. Each member of a list meets the list's few leaders, which joins
most of a large group. Members of lists in which components still meet are posted anew, under the rarest
shingles of their whole sets: those whose own edits are too many come under none. In short lists the others meet all members of other
components; long ones are compared block by block, which returns links only.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from shelfline.llm.common import let_go, lower_bytes, map_arrow, with_package
from shelfline.session import discard, freeze

SHINGLE = 5
PERCENT = 80
COORDINATES = 64
LEADERS = 3                 # of a list, and the likeliest ones that a member is compared with
LIST = 64                   # members of a list of rare shingles that meet pair by pair
BLOCK = 256                 # members that are compared at once in longer ones
BROADCAST_IDS = 1_000_000   # ids of candidates that are broadcast: 8 bytes each
_MIX = np.random.default_rng(7).integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

FINGERPRINT = T.StructType([T.StructField("n", T.LongType()), T.StructField("h1", T.LongType()),
                            T.StructField("h2", T.LongType()), T.StructField("sig", T.ArrayType(T.IntegerType()))])


def least_collisions(percent: int) -> int:
    """The collisions that sets of this similarity have but for odds of 1e-8 or less."""
    p, total = percent / 100, 0.0
    for k in range(COORDINATES + 1):
        total += comb(COORDINATES, k) * p**k * (1 - p)**(COORDINATES - k)
        if total > 1e-8:
            return max(1, k)
    return COORDINATES


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str, size: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; a short text is one shingle."""
    import xxhash
    words = lower_bytes(text).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(h))
    total = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        total = mixed(total + h[k:len(h) - size + 1 + k])
    return np.unique(total)


def fingerprint(found: np.ndarray) -> tuple:
    """(size, 128 bits of the whole set, the least value of each coordinate's order)."""
    import xxhash
    if not len(found):
        return 0, None, None, None
    whole = xxhash.xxh3_128_intdigest(found.tobytes())
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        np.minimum(least, (found[at:at + 2048, None] * _MIX).min(axis=0), out=least)
    return (len(found), signed(whole >> 64), signed(whole & (1 << 64) - 1),
            (least >> np.uint64(32)).astype(np.uint32).view(np.int32))


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """(id, n, h1, h2, sig) of each row of (id, text)."""
    out = T.StructType([docs.schema["id"], *FINGERPRINT.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            made = [fingerprint(shingles(t or "", size)) for t in batch.column(1).to_pylist()]
            columns = [pa.array([m[k] for m in made], t) for k, t in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=out.names)

    return map_arrow(docs, run, out)


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """(id, members): the sorted hashes as bytes, of each row of (id, text)."""
    out = T.StructType([docs.schema["id"], T.StructField("members", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            sets = [shingles(t or "", size).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=out.names)

    return map_arrow(docs, run, out)


def postings(classes: DataFrame, least: int) -> DataFrame:
    """(token, id): each class under the rarest of its tokens that other classes share. The order, by
    length of the list and then by token, is the same for all, so that two classes with `least` tokens
    in common share one of their prefixes' at least."""
    place = F.posexplode("sig").alias("k", "value")
    each = classes.select("id", place).select("id", F.shiftleft(F.col("k").cast("long"), 32).bitwiseOR(
        F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("token"))
    shared = each.groupBy("token").agg(F.count("*").alias("docs")).where("docs > 1")
    own = each.join(shared, "token").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("docs", "token"))).alias("t"))
    own = own.where(F.size("t") >= least)
    prefix = F.slice("t", 1, F.size("t") - least + 1)   # tokens that nobody shares came first and are gone
    return own.select("id", F.explode_outer(prefix).alias("t")).select("t.token", "id")


def _alike(a: Column, b: Column) -> Column:
    """Coordinates in which two signatures agree."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are as similar as sought."""
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("members").alias("of_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("members").alias("of_b")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(both.select("a", "b", "of_a", "of_b"), run, pairs.select("a", "b").schema)


def components(links: DataFrame) -> DataFrame:
    """(id, component): the least id reachable, for each id with a link. Labels go along links and then
    to the label's own label, so that a chain takes a number of steps logarithmic in its length."""
    ends = freeze(links.select("a", "b").unionAll(links.select("b", "a")).distinct(), "ends")
    labels = freeze(ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "id"), "labels")
    kept = labels
    while True:
        near = ends.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near, F.col("id") == F.col("a")).select("id", "component", F.least("component", "near").alias("to"))
        step = freeze(step, "step")
        up = step.select(F.col("id").alias("to"), F.col("to").alias("further"))
        new = freeze(step.join(up, "to").select("id", "component", F.least("to", "further").alias("new")), "labels")
        discard(kept, step)
        kept, labels = new, new.select("id", F.col("new").alias("component"))
        if new.where("component != new").isEmpty():
            return labels


def _sized(pairs: DataFrame, classes: DataFrame, least: int, percent: int) -> DataFrame:
    """Pairs (a, b) that can be similar enough by their sizes and by the collisions of their signatures."""
    side = lambda c: classes.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}"))
    found = pairs.join(side("a"), "a").join(side("b"), "b")
    found = found.where(F.col("n_a") * 100 >= F.col("n_b") * percent).where(F.col("n_b") * 100 >= F.col("n_a") * percent)
    return found.select("a", "b", _alike(F.col("sig_a"), F.col("sig_b")).alias("alike")).where(F.col("alike") >= least)


def shingle_rows(sets: DataFrame) -> DataFrame:
    """(id, s, n, h): one row per hash of each set of (id, members); `s` tells sets of one id apart."""
    out = T._parse_datatype_string("id long, s long, n int, h long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, s, members = batch.slice(at, 256).columns
                size = pc.binary_length(members).to_numpy() // 8
                of = np.repeat(np.arange(len(size)), size)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(of)), s.take(pa.array(of)), pa.array(size[of], pa.int32()),
                    pa.array(np.frombuffer(b"".join(members.to_pylist()), np.int64))], names=out.names)

    return map_arrow(sets.select("id", F.xxhash64("members").alias("s"), "members"), run, out)


def rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """(token, id, n, s): each set under its rarest shingles, as many as any set that is similar enough has to
    share one of; `n` shingles, `s` of which other sets have too. Shingles that no other set has are the
    rarest and link nothing: a set with too many of them is under none, however many others share the rest."""
    each = shingle_rows(sets)
    shared = each.groupBy("h").agg(F.count("*").alias("docs")).where("docs > 1")
    own = each.join(shared, "h").groupBy("id", "s", "n").agg(F.sort_array(F.collect_list(F.struct("docs", "h"))).alias("t"))
    prefix = own.select("id", "n", "t", F.expr(f"int(size(t) + 1 - (cast(n as long) * {percent} + 99) div 100)").alias("most"))
    prefix = prefix.where("most > 0").select("id", "n", F.size("t").alias("s"), F.explode(F.slice("t", F.lit(1), F.col("most"))).alias("t"))
    return prefix.select(F.col("t.h").alias("token"), "id", "n", "s")


def open_lists(at: DataFrame) -> DataFrame:
    """(token, main, docs) of the lists of (token, id, component) in which components meet, their largest one and
    their length."""
    weight = at.select("id", "component").distinct().groupBy("component").agg(F.count("*").alias("ids"))
    return at.join(weight, "component").groupBy("token").agg(
        F.max_by("component", F.struct("ids", "component")).alias("main"), F.min("component").alias("low"),
        F.max("component").alias("high"), F.count("*").alias("docs")).where("low < high").select("token", "main", "docs")


def block_links(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join the components of (cluster, id, component, members) as all links within a cluster
    would. A cluster is dealt into blocks; any two blocks are compared at once, by the products of their sets."""
    sizes = members.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "component", "members")
    out = T._parse_datatype_string("a long, b long")

    def run(rows: pa.Table) -> pa.Table:
        let_go()
        ids, component, block = (rows[c].to_pylist() for c in ("id", "component", "block"))
        sets = [np.frombuffer(m, np.uint64) for m in rows["members"].to_pylist()]
        n = np.array([len(x) for x in sets])
        _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        place = np.cumsum(seen > 1) - 1      # of hashes that several sets have
        held = (seen > 1)[column]
        row, column = np.repeat(np.arange(len(n)), n)[held], place[column[held]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        common = np.zeros((len(n), len(n)))
        for at in range(0, int(place[-1]) + 1, 4096):
            first, stop = np.searchsorted(column, [at, at + 4096])
            part = np.zeros((len(n), 4096), np.float32)
            part[row[first:stop], column[first:stop] - at] = 1
            common += part @ part.T
        alike = np.triu((common > 0) & (100 * common >= percent * (n[:, None] + n[None, :] - common)), 1)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        found = []
        for i, j in zip(*(x.tolist() for x in np.nonzero(alike))):
            if rows["low"][0] == rows["high"][0] or block[i] != block[j]:
                x, y = find(component[i]), find(component[j])
                if x != y:
                    root[x] = y
                    found.append((ids[i], ids[j]))
        return pa.table([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=out.names)

    with_package(members.sparkSession)
    return dealt.groupBy("cluster", "low", "high").applyInArrow(run, out)


def link_classes(classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, component) of the classes that are linked with another one."""
    least = least_collisions(percent)
    posts = freeze(postings(classes, least), "postings")
    wanted = freeze(posts.select("id").distinct(), "candidates")
    small = wanted.count() <= BROADCAST_IDS
    sets = freeze(shingle_sets(docs.join(F.broadcast(wanted) if small else wanted, "id", "left_semi"), size), "sets")
    signed = freeze(classes.join(wanted, "id", "left_semi").select("id", "n", "sig"), "signatures")

    # Members of a list and its leaders, one for each order of the ids.
    leaders = posts.groupBy("token").agg(*[F.min_by("id", F.xxhash64(F.lit(k), "token", "id")).alias(f"of_{k}") for k in range(LEADERS)])
    leaders = leaders.select("token", F.explode(F.array_distinct(F.array(*[f"of_{k}" for k in range(LEADERS)]))).alias("b"))
    pairs = posts.join(leaders, "token").where("id != b").select(F.col("id").alias("a"), "b").distinct()
    likely = _sized(pairs, signed, least, percent).withColumn(
        "place", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("alike"), "b")))
    links = freeze(confirmed(likely.where(F.col("place") <= LEADERS).select("a", "b"), sets, percent), "links")
    labels = components(links)

    def labelled(posts: DataFrame) -> DataFrame:
        return posts.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))

    # Pairs that are left: in lists in which components still meet, members outside the largest one with those of
    # others, if they share one of their rarest shingles.
    at = freeze(labelled(posts), "labelled")
    meeting = at.join(open_lists(at), "token", "left_semi").select("id").distinct()
    open_sets = sets.join(meeting, "id", "left_semi").distinct()
    at = freeze(labelled(rare_shingles(open_sets, percent)), "labelled")
    lists = freeze(open_lists(at), "lists")
    apart = at.join(lists.where(F.col("docs") <= LIST), "token").where("component != main").select(
        "token", F.col("id").alias("x"), F.col("component").alias("of"), F.col("n").alias("n_x"), F.col("s").alias("s_x"))
    pairs = apart.join(at, "token").where("component != of").where(
        (100 + percent) * F.least("s", "s_x").cast("long") >= percent * (F.col("n").cast("long") + F.col("n_x")))
    pairs = pairs.select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")).distinct()
    links = links.unionAll(freeze(confirmed(_sized(pairs, signed, least, percent).select("a", "b"), sets, percent), "links"))

    # Longer lists: all that hang together by them are one cluster, so that no two members meet in each of their lists.
    long = at.join(lists.where(F.col("docs") > LIST), "token")
    heads = long.groupBy("token").agg(F.min("id").alias("b"))
    chained = freeze(long.join(heads, "token").select(F.col("id").alias("a"), "b").distinct(), "clusters")
    if not chained.isEmpty():
        members = components(chained).withColumnRenamed("component", "cluster").join(open_sets, "id")
        members = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
        links = links.unionAll(freeze(block_links(members, percent), "links"))
    return components(links)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of `docs`.

    A document's set are its distinct shingles of `shingle` words, A-Z in lower case; with fewer words
    the whole sequence is one. Documents are linked when 100 * intersection >= percent * union. A null,
    empty or blank text has an empty set and is linked with nothing. The component is the least id
    reachable; a row is kept if its id is that. Rows that share an id are one document with several
    texts: each may link it, and all are kept or none. A row whose id is null is linked with nothing and
    kept, its component is null. Ids have to be integers; other columns are not read.
    """
    read = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    prints = freeze(fingerprints(read, shingle), "fingerprints")
    sets = prints.where("n > 0 and id is not null")
    classes = freeze(sets.groupBy("h1", "h2", "n").agg(F.min("id").alias("class"), F.first("sig").alias("sig")), "classes")
    labels = link_classes(classes.select(F.col("class").alias("id"), "n", "sig"), read, shingle, percent)
    placed = classes.select("h1", "h2", "n", "class").join(
        labels.select(F.col("id").alias("class"), "component"), "class", "left").select(
        "h1", "h2", "n", F.coalesce("component", "class").alias("component"))
    all_rows = prints.select("id", "n", "h1", "h2").join(placed, ["h1", "h2", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return all_rows.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"),
                           F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
