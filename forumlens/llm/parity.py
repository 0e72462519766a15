"""Exact Jaccard links by parity sketches.

A document is its set of distinct word shingles. Its sketch has a number of lanes;
each shingle is dealt to one lane by a hash and flips that lane's 64 parity bits
by XOR. A shingle in only one of two sets changes one lane at most, so the number
of differing lanes never exceeds the size of the symmetric difference. Sets of
sizes a and b with similarity s or more differ in at most (a + b)(1 - s)/(1 + s)
shingles. So if a set has more occupied lanes than that, two linked sets agree in
at least one occupied lane (pigeonhole), and in as many as the difference leaves:
lanes are joined by (size band, lane, value), documents that share too few lanes
with anybody go, and what is left is verified on the whole sets.

Bands are powers of two by set size; a set near the lower edge of its band is
also dealt in the band below, where smaller partners may be. A band's lanes are
the fewest that leave every one of its sets more occupied lanes than it may lose,
found by an aggregation over all sets. Small sets use a lane per shingle.

Only components are asked for, so candidates are taken in two rounds: first each
document against one surviving hub of its lanes, then, between different
components only, pairs that agree in one of a document's rarest lanes (the
prefix that any linked pair must share). A shingle that no other candidate document
has is in no intersection, so the shingles left over bound what a document can share;
a pair whose sizes ask for more is not made. Lanes of a few documents pair them all. The
documents of a larger group, which are each a little too unlike the others, are compared
by what parts them from the group's hub, a bounded group in one task: see ``_delta_pairs``. No pair is lost and large
groups of copies need about one comparison a member.

Defined results: null and wordless texts have the empty set and are linked with
nothing; texts with fewer words than a shingle are one whole shingle. Equal sets
are one class, whose members are linked unless empty. Repeated
rows are one document (an id names one text) and come out repeated. Shingles are
64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrowtext import row_groups, utf8
from .graph import components
from .hashing import mix, windows, words
from .store import written

WORDS, SIMILARITY = 5, 75          # shingle length; percent
SMALL_BAND = 6                     # sets under 2^6 shingles have a lane per shingle
LANES = (0.9, 1.5, 0.0)            # lanes to the band's lower edge; 0: a lane per shingle
LARGE_GROUP = 16                   # groups of a lane from this size on have their hub chosen
HUB_DOCS = 1 << 10                 # a hub's members are compared in one task up to so many
HUB_SHINGLES = 1 << 21             # that differ from the hub in so many shingles
CELLS = 1 << 20                    # of the table of members and shingles looked at together
CHUNK = 1 << 21


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int = WORDS):
    """Sorted distinct shingle hashes of each row and their bounds."""
    hashes, _, _, at = words(raw, offsets, lower=True)
    grams = windows(hashes, k)
    out, bounds = [], [0]
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= k:
            s = np.unique(grams[a:b - k + 1])
        elif b > a:
            s = mix(windows(hashes[a:b], int(b - a)) + np.uint64(b - a))
        else:
            s = np.zeros(0, np.uint64)
        out.append(s)
        bounds.append(bounds[-1] + len(s))
    return out, np.array(bounds)


def _each_set(batch):
    """(row, set) of every text of a batch, a bounded number of bytes at a time."""
    raw, offsets = utf8(batch.column("__text"))
    for a, b in row_groups(offsets, CHUNK):
        sets, _ = shingle_sets(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        for i, s in enumerate(sets):
            yield a + i, s


def most_lost(size: int, partner: int, percent: int = SIMILARITY) -> int:
    """The largest symmetric difference of linked sets of these sizes."""
    return (size + partner) * (100 - percent) // (100 + percent)


def band_places(size: int, percent: int = SIMILARITY) -> list[tuple[int, int]]:
    """(band, shingles it may lose there) of a set: its own band, and the one below if that has partners."""
    band = size.bit_length() - 1
    places = [(band, most_lost(size, size * 100 // percent, percent))]
    below = (1 << band) - 1
    if band and below * 100 >= size * percent:
        places.append((band - 1, most_lost(size, below, percent)))
    return places


def sketch(shingles: np.ndarray, n_lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Occupied lanes and their parity words; ``n_lanes`` 0 gives each shingle its own."""
    if not n_lanes:
        return shingles, shingles
    lane = mix(shingles ^ np.uint64(0x5BD1E995)) % np.uint64(n_lanes)
    order = np.argsort(lane, kind="stable")
    lane, value = lane[order], shingles[order]
    first = np.flatnonzero(np.r_[True, lane[1:] != lane[:-1]]) if len(lane) else np.zeros(0, int)
    return lane[first], np.bitwise_xor.reduceat(value, first) if len(first) else value


def _lanes(band: int, choice: int) -> int:
    return 0 if band < SMALL_BAND or not LANES[choice] else int(LANES[choice] * (1 << band))


def _fingerprint(s: np.ndarray) -> tuple[str, int]:
    """A set's name, and its class in 64 bits, as a signed number."""
    same = (int(np.bitwise_xor.reduce(mix(s))) ^ len(s)) if len(s) else 0
    low = int(np.add.reduce(s)) if len(s) else 0
    both = mix(np.array([same], np.uint64) + mix(np.array([low], np.uint64)))
    return f"{same:016x}{low:016x}", int(both.view(np.int64)[0])


def _profile(docs: DataFrame) -> DataFrame:
    """(doc, n, same, cls, margins): set size, a fingerprint of the set, its class, and per LANES the spare occupied lanes."""
    def run(batches):
        for batch in batches:
            ids = batch.column("doc")
            rows = []
            for i, s in _each_set(batch):
                n = len(s)
                margins = [[b, *(n - lost if not _lanes(b, c) else len(np.unique(
                    mix(s ^ np.uint64(0x5BD1E995)) % np.uint64(_lanes(b, c)))) - lost for c in range(2))]
                    for b, lost in (band_places(n) if n else [])]
                rows.append((i, n, *_fingerprint(s), margins))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.int64()),
                 pa.array([r[4] for r in rows], pa.list_(pa.list_(pa.int32())))], names=["doc", "n", "same", "cls", "margins"])

    return docs.mapInArrow(run, "doc long, n long, same string, cls long, margins array<array<int>>")


def _choose_lanes(profile: DataFrame) -> dict[int, int]:
    """Band to the first of LANES that leaves all its sets a spare occupied lane."""
    worst = (profile.select(F.explode("margins").alias("m")).groupBy(F.col("m")[0].alias("band"))
             .agg(F.min(F.col("m")[1]).alias("m0"), F.min(F.col("m")[2]).alias("m1")).collect())
    return {r["band"]: 0 if r["m0"] > 0 else 1 if r["m1"] > 0 else len(LANES) - 1 for r in worst}


def _lane_rows(docs: DataFrame, choice: dict[int, int]) -> DataFrame:
    """(key, cls, place): a row per occupied lane; place holds the band and the lanes a partner must share.
    Copies that a task has seen are left out; other copies are told by their class."""
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            keys, classes, places, size = [], [], [], 0

            def out():
                return pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(classes)),
                    pa.array(np.concatenate(places))], names=["key", "cls", "place"])

            for _, s in _each_set(batch):
                cls = _fingerprint(s)[1]
                if cls in seen:
                    continue
                seen.add(cls)
                for band, lost in band_places(len(s)) if len(s) else []:
                    lane, value = sketch(s, _lanes(band, choice[band]))
                    keys.append(mix(mix(value + lane) ^ np.uint64(band)))
                    classes.append(np.full(len(lane), cls, np.int64))
                    places.append(np.full(len(lane), band << 40 | (len(lane) - lost), np.int64))
                    size += len(lane)
                if size > 1 << 19:
                    yield out()
                    keys, classes, places, size = [], [], [], 0
            if size:
                yield out()

    return docs.mapInArrow(run, "key long, cls long, place long")


def _shared(rows: DataFrame) -> DataFrame:
    """The rows whose key at least two classes have, once per class. Streams over rows sorted by key and class; holds no group."""
    def run(batches):
        held = None          # the last row, not yet known to be shared
        for batch in batches:
            key, cls = np.asarray(batch.column("key")), np.asarray(batch.column("cls"))
            copy = np.r_[False, (key[1:] == key[:-1]) & (cls[1:] == cls[:-1])][:len(key)]
            if held is not None and len(key):
                copy[0] = key[0] == held[0].column("key")[0].as_py() and cls[0] == held[0].column("cls")[0].as_py()
            if copy.any():
                batch = batch.filter(pa.array(~copy))
                key = key[~copy]
            if not len(key):
                continue
            same = np.r_[False, key[1:] == key[:-1]]
            if held is not None:
                same[0] = key[0] == held[0].column("key")[0].as_py()
                if held[1] or same[0]:
                    yield held[0]
            keep = same.copy()
            keep[:-1] |= same[1:]
            last = len(key) - 1
            held = (batch.slice(last), bool(same[last]))
            keep[last] = False
            if keep.any():
                yield batch.filter(pa.array(keep))
        if held is not None and held[1]:
            yield held[0]

    return rows.repartition("key").sortWithinPartitions("key", "cls").mapInArrow(run, rows.schema)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """The pairs (x, y) whose sets reach the similarity."""
    both = (pairs.join(sets.select(F.col("doc").alias("x"), F.col("shingles").alias("sx")), "x")
            .join(sets.select(F.col("doc").alias("y"), F.col("shingles").alias("sy")), "y"))
    common = F.size(F.array_intersect("sx", "sy"))
    union = F.size("sx") + F.size("sy") - common
    return both.where(100 * common >= percent * union).select("x", "y")


def _bounds(sets: DataFrame) -> DataFrame:
    """(doc, n, most): set size and how many of its shingles any other document has."""
    lone = (sets.select("doc", F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("times"), F.min(
        "doc").alias("doc")).where("times = 1").groupBy("doc").agg(F.count("*").alias("lone")))
    size = sets.select("doc", F.size("shingles").alias("n")).join(lone, "doc", "left")
    return size.select("doc", "n", (F.col("n") - F.coalesce("lone", F.lit(0))).alias("most"))


def _hub_links(members: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links (x, y) that join the far members of one hub to all members they reach, near ones being one component."""
    both = 2 * (100 + percent)
    far, w, doc = members["far"].to_numpy(bool), members["w"].to_numpy(np.int64), members["doc"].to_numpy(np.int64)
    m = len(doc)
    owner = np.repeat(np.arange(m), members["apart"].map(len).to_numpy(np.int64))
    _, at, times = np.unique(np.concatenate(members["apart"].to_list()), return_inverse=True, return_counts=True)
    owner, at = owner[times[at] > 1], np.searchsorted(np.flatnonzero(times > 1), at[times[at] > 1])
    common, step = np.zeros((m, m), np.int64), max(1, CELLS // m)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, step):
        a, b = np.searchsorted(at, [low, low + step])
        table = np.zeros((m, step), np.float32)
        table[owner[a:b], at[a:b] - low] = 1
        common += (table @ table.T).astype(np.int64)
    linked = w[:, None] + w[None, :] <= both * common
    x, y, left = [], [], far.copy()
    front = np.flatnonzero(~far)
    while len(front) or left.any():
        if not len(front):
            front = np.flatnonzero(left)[:1]
            left[front] = False
        rest = np.flatnonzero(left)
        reached = linked[np.ix_(front, rest)]
        hit = np.flatnonzero(reached.any(axis=0))
        x += doc[rest[hit]].tolist()
        y += doc[front[reached[:, hit].argmax(axis=0)]].tolist() if len(hit) else []
        front = rest[hit]
        left[front] = False
    return pd.DataFrame({"x": np.array(x, np.int64), "y": np.array(y, np.int64)})


def _delta_pairs(members: DataFrame, sets: DataFrame, percent: int = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Links (x, y) of members, and the other pairs (x, y) of members that may link.

    ``members``: distinct (hub, doc, component), doc not the hub. Let D be the symmetric difference of a
    member and the hub. Two members that share c shingles of their Ds differ in D_x + D_y - 2c shingles, so
    with the weights w = (100 + s) D - (100 - s) n linked ones have c >= (w_x + w_y) / 2(100 + s). A member
    is near if linked with the hub, that is w <= (100 - s) n_hub; near ones are in one component, and a
    pair with a far one asks for c > 0. So far members meet others in the rarest shingles of their Ds,
    as many as c leaves, by bands of the partner's weight; shingles in the Ds of one
    component only count for nothing. Copies with edits of their own share few of them.

    That is for groups beyond HUB_DOCS and HUB_SHINGLES. In smaller ones a task counts c for all pairs
    with a far member, which settles them: a row for each shingle would be more than there are pairs.
    """
    other, both = 100 - percent, 2 * (100 + percent)
    of_hub = sets.select(F.col("doc").alias("hub"), F.col("shingles").alias("base"))
    apart = F.concat(F.array_except("shingles", "base"), F.array_except("base", "shingles"))
    near_up_to = other * F.size("base").cast("long")
    deltas = members.join(sets, "doc").join(of_hub, "hub").withColumn("apart", apart).select(
        "hub", "doc", "component", "apart", near_up_to.alias("near_up_to"),
        (both / 2 * F.size("apart") - other * F.size("shingles")).cast("long").alias("w"),
        (both * F.greatest(F.lit(4), F.floor(F.size("base") / 32))).cast("long").alias("width"))
    deltas = written(deltas.withColumn("far", F.col("w") > F.col("near_up_to")).withColumn(
        "band", F.floor(F.col("w") / F.col("width"))), "parity-deltas")
    linked = deltas.where("NOT far").select(F.col("doc").alias("x"), F.col("hub").alias("y"))
    sizes = deltas.groupBy("hub").agg(
        F.count("*").alias("docs"), F.sum(F.size("apart")).alias("shingles"), F.max("far").alias("any")).where("any")
    sizes = sizes.select("hub", ((F.col("docs") <= HUB_DOCS) & (F.col("shingles") <= HUB_SHINGLES)).alias("small"))
    deltas = deltas.join(sizes, "hub")
    linked = linked.union(deltas.where("small").select("hub", "doc", "apart", "w", "far").groupBy("hub").applyInPandas(
        lambda members: _hub_links(members, percent), "x long, y long"))
    deltas = deltas.where("NOT small").drop("small")

    # near members are one component here, so a shingle that only they lack parts none of them from another
    part = F.when(F.col("far"), F.col("component")).otherwise(F.lit(None)).alias("part")
    single = deltas.select("hub", "doc", part, F.explode("apart").alias("e"))
    counts = single.groupBy("hub", "e").agg(
        F.count("*").alias("times"), F.min("part").alias("a"), F.max("part").alias("b"), F.count("part").alias("fars"))
    counts = counts.where("fars > 0 AND (fars < times OR a < b)").select("hub", "e", "times")
    each = Window.partitionBy("hub", "doc")
    placed = single.join(counts, ["hub", "e"]).select(
        "hub", "doc", "e", F.row_number().over(each.orderBy("times", "e")).alias("rank"), F.count("*").over(each).alias("usable"))
    lowest = deltas.groupBy("hub").agg(F.min("band").alias("lowest"))
    placed = placed.join(deltas.drop("apart"), ["hub", "doc"]).join(lowest, "hub")
    # c can't be more than the shingles from this rank on
    placed = written(placed.withColumn("rest", (F.col("usable") - F.col("rank") + 1).cast("long")), "parity-placed")
    least = F.greatest(F.col("band") * F.col("width"), F.col("near_up_to") + 1)
    y = placed.where(F.col("w") + least <= both * F.col("rest"))
    top = F.least("band", F.floor((both * F.col("rest") - F.col("w")) / F.col("width")))
    x = placed.where("far").withColumn("top", top).where("top >= lowest").withColumn(
        "meets", F.explode(F.sequence("lowest", "top")))
    x = x.select("hub", "e", F.col("meets").alias("band"), F.col("band").alias("band_x"), *(
        F.col(c).alias(f"{c}_x") for c in ("doc", "component", "w", "rest")))
    y = y.select("hub", "e", "band", "far", *(F.col(c).alias(f"{c}_y") for c in ("doc", "component", "w", "rest")))
    once = ~F.col("far") | (F.col("band") < F.col("band_x")) | (F.col("doc_x") < F.col("doc_y"))
    met = x.join(y, ["hub", "e", "band"]).where(
        once & (F.col("component_x") != F.col("component_y")) & (F.col("doc_x") != F.col("doc_y")) & (
            F.col("w_x") + F.col("w_y") <= both * F.least("rest_x", "rest_y")))
    return linked, met.select(F.col("doc_x").alias("x"), F.col("doc_y").alias("y"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, n_shingles, component_id (smallest ``key`` reachable by links)."""
    source = docs.select(F.col(key).alias("doc"), F.col(text).alias("__text"))
    profile = written(_profile(source), "parity-profile")
    choice = _choose_lanes(profile)
    classes = profile.where("n > 0").groupBy("same", "cls").agg(F.min("doc").alias("rep"))
    classes = written(classes, "parity-classes")
    shared = written(_shared(_lane_rows(source, choice)), "parity-shared")

    # from here on the smallest document of a class stands for it, with one text
    named = classes.where("rep IS NOT NULL").groupBy(F.col("rep").alias("doc")).agg(F.min("cls").alias("cls"))
    enough = shared.groupBy("cls", "place").agg(F.count("*").alias("have")).where(
        F.col("have") >= F.col("place") % (1 << 40))
    lanes = written(shared.join(enough.join(named, "cls").select("cls", "place", "doc"), ["cls", "place"]).select(
        "key", "doc", "place"), "parity-lanes")
    groups = lanes.groupBy("key").agg(F.min("doc").alias("first"), F.count("*").alias("size")).where("size > 1")
    lanes = written(lanes.join(groups, "key"), "parity-groups")
    # the hub of a large group: the member that agrees with most others over all its lanes
    large = lanes.where(F.col("size") >= LARGE_GROUP)
    weight = large.groupBy("doc").agg(F.sum("size").alias("weight"))
    hubs = large.join(weight, "doc").groupBy("key").agg(F.max(F.struct("weight", (-F.col("doc")).alias("of"))).alias("hub"))
    hubs = hubs.select("key", (-F.col("hub.of")).alias("hub"))

    def sets_of(ids: DataFrame) -> DataFrame:
        def run(batches):
            for batch in batches:
                names, classes_ = batch.column("doc"), np.asarray(batch.column("cls"))
                for i, s in _each_set(batch):
                    if _fingerprint(s)[1] != classes_[i]:
                        continue
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[i:i + 1]), pa.ListArray.from_arrays(
                            pa.array([0, len(s)], pa.int32()), pa.array(s.view(np.int64)))], names=["doc", "shingles"])
        # a merge join brings the rows of an id together, so that repeated ones go without one more shuffle
        return source.join(ids.hint("merge"), "doc").dropDuplicates(["doc", "__text"]).mapInArrow(
            run, "doc long, shingles array<long>")

    ids = written(lanes.select("doc").distinct().join(named, "doc"), "parity-ids")
    sets = written(sets_of(ids), "parity-sets")
    need = F.col("place") % (1 << 40)
    starred = lanes.join(hubs, "key", "left").withColumn("hub", F.coalesce("hub", "first")).where("doc <> hub")
    stars = (starred.groupBy(F.col("doc").alias("x"), F.col("hub").alias("y"), "place")
             .agg(F.count("*").alias("have")).where(F.col("have") >= need).select("x", "y").distinct())
    links = written(_verify(stars, sets), "parity-links")
    found = written(components(links, "x", "y"), "parity-found")

    # Second round: the rarest lanes of each document, as many as a linked pair cannot all miss.
    placed = lanes.join(found, lanes["doc"] == found["node"], "left").select(
        "key", "doc", "place", "size", F.coalesce("component", "doc").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    rank = F.row_number().over(Window.partitionBy("doc", "place").orderBy("size", "key"))
    have = F.count("*").over(Window.partitionBy("doc", "place"))
    rare = (placed.withColumn("rank", rank).withColumn("have", have).where(F.col("rank") <= F.col("have") - need + 1)
            .join(mixed.select("key"), "key", "left_semi"))
    bounds = _bounds(sets).where(100 * F.col("most") >= SIMILARITY * F.col("n"))
    rare = rare.join(bounds, "doc").join(hubs, "key", "left").select("key", "doc", "component", "n", "most", "hub")
    rare = written(rare, "parity-rare")
    few = rare.where("hub IS NULL")
    x, y = (few.select("key", F.col("doc").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in (
        "component", "n", "most"))) for side in "xy")
    most = F.least("most_x", "most_y")
    rest = x.join(y, "key").where((F.col("component_x") != F.col("component_y")) & (F.col("x") < F.col("y")) & (
        100 * most >= SIMILARITY * (F.col("n_x") + F.col("n_y") - most))).select("x", "y")
    near, unlike = _delta_pairs(rare.where("hub <> doc").select("hub", "doc", "component").distinct(), sets)
    rest = rest.union(unlike).distinct()
    links = written(links.union(near).union(_verify(rest, sets)), "parity-all-links")
    joined = components(links, "x", "y")

    label = classes.join(joined, classes["rep"] == joined["node"], "left").select(
        "same", F.coalesce("component", "rep").alias("c"))
    label = profile.where("n > 0").join(label, "same").groupBy("doc").agg(F.min("c").alias("c"))
    return profile.select("doc", "n").join(label, "doc", "left").select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.coalesce("c", "doc").alias("component_id"))


def op9_parity_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs)
