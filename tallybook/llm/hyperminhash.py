"""Near-duplicate texts by HyperMinHash.

Every text is a set of shingles of ``width`` words. A shingle's hash falls into one of 256
buckets, and of the smallest hash in a bucket a register keeps the number of leading zeros and ten mantissa
bits: 512 bytes a text, however long. Then:

1. Equal sets form classes; one text of each goes on, found by its id and a hash of it. Bands and clusters
   hold classes by their number, since an id may have several; their links are told by ids.
2. Registers are banded, where an empty register takes the value of a filled one that is the same in
   every text. Texts that agree in a band meet in a bucket, and the first class of a bucket is its leader.
3. Leader first: each text of a bucket is compared with the leader, by similarity estimated from the registers and corrected for
   chance collisions. Those near it are loosely linked; only those that are not are compared with all others of the buckets that
   have this leader. Two bands go first. Of the others, buckets count that hold texts not yet loosely linked
   with each other, so a cluster of near copies, which meets in every band, sends its registers a few times and not once a band.
4. Loose links give clusters; similar texts are in one cluster. In a cluster each text's full set is compared with that of one
   leader, the one that most near texts have had, and only texts that stay apart from it are compared with all others.

What stays apart is cut into blocks, and every block of it meets every block of the others; all
limits bound memory and none drops a pair. The banding misses a pair at the threshold with a chance
below 5e-6. Shingles are 64-bit hashes, so two different ones count as equal with a chance of about 2**-64.

Texts that are null, empty or without words have no shingles and link with nothing. Rows without id are
returned with no component and are kept. Rows that repeat an id count as one document with the texts of all.
Each input row gives one output row; an empty table gives none. Columns of any name beside the two that are read are not looked at.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import mix, slices, text_bytes, word_hashes
from tallybook.llm.components import components
from tallybook.operators.load import written
from tallybook.scratch import scratch_dir

#: Registers of a text (a power of two) and mantissa bits; texts of a bucket and shingles of a cluster in one task.
REGISTERS, MANTISSA = 256, 10
BLOCK_TEXTS, BLOCK_SHINGLES = 1500, 1_500_000
#: Words of the bit table that tells which rows are wanted (a broadcast of a few megabytes), whatever the size of the data.
WORDS = 1 << 18
#: Bands that go before the others.
FIRST_BANDS = 2
#: The chance to miss a pair at the threshold that banding may have.
MISSED = 5e-6
ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


def band_rows(percent: int) -> int:
    """The most registers in a band with which pairs at the threshold are missed as rarely as asked."""
    return max(r for r in range(1, 17) if r == 1 or (1 - (percent / 100)**r)**(REGISTERS // r) <= MISSED)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``width`` are one shingle, no words none."""
    words, _, first = word_hashes(data, offsets)
    terms = [words * np.uint64(ODD[k % len(ODD)] + 2 * k) for k in range(width)]
    rolled = mix(sum(t[k:len(t) - width + 1 + k] for k, t in enumerate(terms))) if len(words) >= width else words[:0]
    out = []
    for a, b in zip(first.tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(rolled[a:b - width + 1]))
        elif b > a:
            short = np.uint64(b - a) + sum(terms[k][a + k:a + k + 1] for k in range(b - a))
            out.append(mix(short))
        else:
            out.append(words[:0])
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of registers per set; 0 is an empty bucket."""
    out = np.zeros((len(sets), REGISTERS), dtype=np.uint16)
    if not sets:
        return out
    size = np.array([len(s) for s in sets])
    every, text = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    place = text * REGISTERS + (every >> np.uint64(56)).astype(np.int64)  # sets are sorted, so places are too
    first = np.flatnonzero(np.diff(place, prepend=-1))
    least = (every[first] >> np.uint64(8)) & np.uint64((1 << 48) - 1)
    digits = np.frexp(least.astype(np.float64))[1]
    zeros = (48 - digits).astype(np.uint64)
    mantissa = ((least << zeros) & np.uint64((1 << 47) - 1)) >> np.uint64(47 - MANTISSA)
    out.reshape(-1)[place[first]] = (1 + (zeros << np.uint64(MANTISSA)) + mantissa).astype(np.uint16)
    return out


def lenders() -> np.ndarray:
    """For every register the order in which the others lend to it when it is empty; the same everywhere."""
    rng = np.random.default_rng(20)
    return np.argsort(rng.random((REGISTERS, REGISTERS)), axis=1).argsort(axis=1)


def band_keys(rows: np.ndarray, size: int) -> np.ndarray:
    """The key of every band of registers per text, empty registers lent to; texts without registers have none (0)."""
    order, filled = lenders(), rows > 0
    full = rows.copy()
    for i in np.flatnonzero(filled.any(axis=1) & ~filled.all(axis=1)):
        has, lacks = np.flatnonzero(filled[i]), np.flatnonzero(~filled[i])
        full[i, lacks] = rows[i, has[order[np.ix_(lacks, has)].argmin(axis=1)]]
    count = REGISTERS // size
    bands = full[:, :count * size].reshape(len(rows), count, size).astype(np.uint64)
    keys = np.tile(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(ODD[1]), (len(rows), 1))
    for k in range(size):
        keys = mix(keys + bands[:, :, k] * np.uint64(ODD[0]))
    return keys


def similarity(one: np.ndarray, rows: np.ndarray, n_one: int | np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated Jaccard similarity of one text with others (or of two texts row by row), and the registers it rests on.

    Registers also agree by chance, 0.1699 * 2**(p - r) times 4 x / (1 + x)**2 for sets of size ratio x (the
    method's approximation); that many agreements are taken off.
    """
    either = np.maximum(((rows > 0) | (one > 0)).sum(axis=1), 1)
    equal = ((rows == one) & (rows > 0)).sum(axis=1)
    ratio = n / n_one
    by_chance = 0.169919487159739093975315 * REGISTERS / 2**MANTISSA * 4 * ratio / (1 + ratio)**2
    return np.clip((equal - by_chance) / either, 0, 1), either


def maybe_similar(rows: np.ndarray, n: np.ndarray, one: np.ndarray, n_one: int, percent: int) -> np.ndarray:
    """Which texts may be similar to one: the estimate is no more than four deviations below the threshold."""
    near, seen = similarity(one, rows, n_one, n)
    return near >= percent / 100 - 4 * 0.5 / np.sqrt(seen)


def loose_links(rows: np.ndarray, n: np.ndarray, apart: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links of the texts apart with any that may be similar, without those that others make superfluous."""
    links, group = [], np.arange(len(rows))
    for i in np.flatnonzero(apart):
        linked = maybe_similar(rows, n, rows[i], n[i], percent)
        others, first = np.unique(group[linked], return_index=True)
        links += [(int(i), int(j)) for j, g in zip(np.flatnonzero(linked)[first], others) if g != group[i]]
        group[np.isin(group, others)] = group[i]
    return links


def connected(sets: list[np.ndarray], apart: np.ndarray, united: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Exact links of the sets apart, with each other and with all others, that connect them as all such links would.

    ``united`` tells which of the others are connected anyway: one link with any of them is enough.
    """
    size = np.array([len(s) for s in sets], dtype=np.int64)
    every, number = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(size) - size
    marked, links = np.zeros(len(every), dtype=bool), []
    waiting = apart & (size > 0)

    def similar(one: int, held: np.ndarray) -> np.ndarray:
        """Which of some sets are similar to one; sizes that differ too much are told without a look."""
        held = held[(100 * np.minimum(size[held], size[one]) >= percent * np.maximum(size[held], size[one]))]
        if not len(held):
            return held
        own = number[starts[one]:starts[one] + size[one]]
        marked[own] = True
        ends = np.cumsum(size[held])
        at = ends - size[held]
        members = number[np.repeat(starts[held] - at, size[held]) + np.arange(ends[-1])]
        common = np.add.reduceat(marked[members].astype(np.int64), at)
        marked[own] = False
        return held[100 * common >= percent * (size[one] + size[held] - common)]

    others = np.flatnonzero(~apart & (size > 0))
    for seed in np.flatnonzero(waiting).tolist():
        if not waiting[seed]:
            continue
        waiting[seed], queue, left = False, [seed], others
        while queue:
            one = queue.pop()
            for i in similar(one, np.flatnonzero(waiting)).tolist():
                waiting[i] = False
                links.append((one, i))
                queue.append(i)
            hit = similar(one, left)
            if len(hit):
                joined = united[hit]
                links += [(one, int(i)) for i in hit[~joined]] + [(one, int(i)) for i in hit[joined][:1]]
                left = np.setdiff1d(left, hit[~joined], assume_unique=True)
                if joined.any():
                    left = left[~united[left]]
    return links


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(id, hash, n, low, high, registers) per row: the text's hash, the set's size, a 128-bit digest of it, its registers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*text_bytes(part.column("text")), width)
                low = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                high = np.array([mix(s).sum(dtype=np.uint64) if len(s) else 0 for s in sets], dtype=np.uint64)
                made = registers(sets)
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array(low.view(np.int64)),
                    pa.array(high.view(np.int64)), pa.array([r.tobytes() for r in made], pa.binary())],
                    ["id", "hash", "n", "low", "high", "registers"])

    return _slim(docs).mapInArrow(run, "id long, hash long, n long, low long, high long, registers binary")


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select("id", F.xxhash64("text").alias("hash"), "text")


def _banded(classes: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 1024):
                part = batch.slice(a, 1024)
                rows = np.array([np.frombuffer(r, np.uint16) for r in part.column("registers").to_pylist()])
                keys = band_keys(rows, size).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1]), pa.int32()),
                                                 pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column("class"), lists], ["class", "bands"])

    return classes.select("class", "registers").mapInArrow(run, "class long, bands array<long>")


def _likely(rows: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """The rows whose keys may be among the wanted ones, so that few others are shuffled to meet them.

    Hashes of the wanted keys set bits in a table of at most ``WORDS`` words of 64, which is therefore broadcast. The more bits are
    set, the more rows pass; a row with a wanted key always does.
    """
    slot, bit = F.pmod(F.xxhash64(*keys), F.lit(64 * WORDS)), F.expr("CAST(_slot % 64 AS INT)")
    words = wanted.select(slot.alias("_slot")).groupBy(F.expr("_slot DIV 64").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(_slot % 64 AS INT))")).alias("_bits"))
    marked = rows.withColumn("_slot", slot).withColumn("_word", F.expr("_slot DIV 64"))
    return marked.join(F.broadcast(words), "_word").where(F.getbit("_bits", bit) == 1).drop("_slot", "_word", "_bits")


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Each row once for every pair (p, q) of a block of those apart and a block of all that it is needed in.

    Rows have ``class``, ``apart`` and the numbers of blocks ``ps`` and ``qs``; ``seed`` tells those that stand for block p.
    """
    mine = F.pmod(F.xxhash64("class"), F.col("ps")), F.pmod(F.xxhash64("class", F.lit(1)), F.col("qs"))
    upto = [F.sequence(F.lit(0).cast("long"), F.col(c) - 1) for c in ("ps", "qs")]
    met = F.transform(upto[0], lambda p: F.struct(p.alias("p"), mine[1].alias("q"), (F.col("apart") & (p == mine[0])).alias("seed")))
    meets = F.transform(F.filter(upto[1], lambda q: q != mine[1]), lambda q: F.struct(
        mine[0].alias("p"), q.alias("q"), F.lit(True).alias("seed")))
    pairs = F.when(F.col("apart"), F.concat(met, meets)).otherwise(met)
    return rows.withColumn("_pair", F.explode(pairs)).select("*", "_pair.p", "_pair.q", "_pair.seed").drop("_pair", "ps", "qs")


def _links_of_buckets(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("class").sort_values("class")
        ids = group["class"].to_numpy()
        rows = np.array([np.frombuffer(r, np.uint16) for r in group["registers"]])
        links = loose_links(rows, group["n"].to_numpy(dtype=float), group["seed"].to_numpy(dtype=bool), percent)
        return pd.DataFrame([(ids[i], ids[j]) for i, j in links], columns=["a", "b"], dtype="int64")

    return run


def _links_of_clusters(width: int, percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("class").sort_values("class")
        ids, seeds = group["id"].to_numpy(), group["seed"].to_numpy(dtype=bool)
        sets = shingle_sets(*text_bytes(pa.array(group["text"], pa.large_string())), width)
        links = connected(sets, seeds, ~group["apart"].to_numpy(dtype=bool), percent)
        return pd.DataFrame([(ids[i], ids[j]) for i, j in links], columns=["a", "b"], dtype="int64")

    return run


def _near_leader(percent: int):
    """Whether a text's registers may be similar to its leader's, row by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 1024):
                part = batch.slice(a, 1024)
                mine, theirs = (np.array([np.frombuffer(r, np.uint16) for r in part.column(c).to_pylist()])
                                for c in ("registers", "leader_registers"))
                n, n_leader = (part.column(c).to_numpy().astype(float) for c in ("n", "leader_n"))
                near = maybe_similar(mine, n, theirs, n_leader, percent)
                yield pa.RecordBatch.from_arrays([part.column("leader"), part.column("class"), pa.array(near)],
                                                 ["leader", "class", "near"])

    return run


def _linked_with_leader(width: int, percent: int):
    """Whether a text's full set is similar to its leader's, row by row; a leader's set is made once for rows in a run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, leader = None, None
        for batch in batches:
            for part in slices(batch, "text"):
                linked = []
                sets = shingle_sets(*text_bytes(part.column("text")), width)
                for row, (component, own) in enumerate(zip(part.column("component").to_pylist(), sets)):
                    if component != known:
                        known = component
                        leader = shingle_sets(*text_bytes(part.column("leader_text").slice(row, 1)), width)[0]
                    common = len(np.intersect1d(own, leader, assume_unique=True))
                    linked.append(100 * common >= percent * (len(own) + len(leader) - common))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("component", "class", "id", "leader_id", "n")), pa.array(linked, pa.bool_())],
                    ["component", "class", "id", "leader_id", "n", "linked"])

    return run


def _bucket_links(classes: DataFrame, bands: DataFrame, loose: DataFrame | None, percent: int) -> DataFrame:
    """(a, b): loose links of classes that meet in the given bands; ``loose`` has the clusters known before."""
    spark = classes.sparkSession
    places = bands.select("class", F.explode("bands").alias("band"))
    leaders = places.groupBy("band").agg(F.count("*").alias("size"), F.min("class").alias("leader")).where("size > 1")
    met = places.join(leaders.drop("size"), "band").where("class <> leader").select("leader", "class").distinct()
    met = written(met, scratch_dir(spark, "met"))
    asked = met
    if loose is not None:
        for end in ("leader", "class"):
            held = loose.select(F.col("id").alias(end), F.col("component").alias(f"{end}_held"))
            asked = asked.join(held, end, "left")
        asked = asked.where(~F.coalesce(F.col("leader_held") == F.col("class_held"), F.lit(False))).select("leader", "class")
        asked = written(asked, scratch_dir(spark, "asked"))  # with its size known, registers are not shuffled to meet few pairs
    mine = classes.select("class", "n", "registers")
    theirs = classes.select(F.col("class").alias("leader"), F.col("n").alias("leader_n"), F.col("registers").alias("leader_registers"))
    followers, heads = asked.select("class"), asked.select("leader")
    compared = asked.join(_likely(mine, ["class"], followers), "class").join(_likely(theirs, ["leader"], heads), "leader").mapInArrow(
        _near_leader(percent), "leader long, class long, near boolean")
    compared = written(compared, scratch_dir(spark, "compared"))
    near = compared.where("near").select(F.col("leader").alias("a"), F.col("class").alias("b"))

    far = compared.where("NOT near").select("leader", "class")
    some = far.groupBy("leader").agg(F.ceil(F.count("*") / BLOCK_TEXTS).alias("ps"))
    every = met.groupBy("leader").agg(F.count("*").alias("size")).where("size > 1").select(
        "leader", F.ceil(F.col("size") / BLOCK_TEXTS).alias("qs"))
    groups = written(some.join(every, "leader"), scratch_dir(spark, "groups"))
    rest = met.join(groups, "leader").join(far.withColumn("apart", F.lit(True)), ["leader", "class"], "left").withColumn(
        "apart", F.coalesce("apart", F.lit(False)))
    rest = written(rest, scratch_dir(spark, "rest"))
    rest = rest.join(_likely(mine, ["class"], rest), "class")
    others = _in_blocks(rest).groupBy("leader", "p", "q").applyInPandas(_links_of_buckets(percent), "a long, b long")
    return near.unionByName(others)


def _loose_clusters(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(id, component) of classes that may be similar to another, and the links that say so."""
    spark, size = classes.sparkSession, band_rows(percent)
    bands = written(_banded(classes, size), scratch_dir(spark, "bands"))
    loose, links = None, None
    for first, count in ((1, FIRST_BANDS), (1 + FIRST_BANDS, REGISTERS // size - FIRST_BANDS)):
        some = bands.select("class", F.slice("bands", first, count).alias("bands"))
        found = written(_bucket_links(classes, some, loose, percent), scratch_dir(spark, "loose"))
        known = loose.select(F.col("id").alias("a"), F.col("component").alias("b")) if loose else found.limit(0)
        links = found.unionByName(links) if links else found
        loose = components(found.unionByName(known))
    return loose, links


def _exact_links(docs: DataFrame, classes: DataFrame, loose: DataFrame, links: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): ids whose full sets are similar, enough of them to connect all that are."""
    spark = classes.sparkSession
    followers = links.groupBy(F.col("a").alias("class")).agg(F.count("*").alias("followers"))
    clusters = loose.select(F.col("id").alias("class"), "component").join(classes.select("class", "id", "hash", "n"), "class").join(
        followers, "class", "left")
    chosen = clusters.groupBy("component").agg(
        F.max_by("class", F.struct(F.coalesce("followers", F.lit(0)).alias("f"), (-F.col("class")).alias("c"))).alias("leader"))
    told = written(clusters.drop("followers").join(chosen, "component").withColumn("leads", F.col("class") == F.col("leader")).drop("leader"),
                   scratch_dir(spark, "clusters"))
    texts = _likely(_slim(docs), ["id", "hash"], told).join(told, ["id", "hash"])
    whole = written(texts, scratch_dir(spark, "clustered-texts"))
    members = whole.where("NOT leads")
    leaders = whole.where("leads").groupBy("component").agg(F.first("id").alias("leader_id"), F.first("text").alias("leader_text"))
    compared = members.select("component", "class", "id", "n", "text").join(leaders, "component").mapInArrow(
        _linked_with_leader(width, percent), "component long, class long, id long, leader_id long, n long, linked boolean")
    compared = written(compared.distinct(), scratch_dir(spark, "linked"))
    linked = compared.where("linked").select(F.col("leader_id").alias("a"), F.col("id").alias("b"))

    apart = compared.where("NOT linked").select("component", "class")
    groups = compared.groupBy("component").agg(
        F.count("*").alias("size"), F.ceil(F.sum(F.when(~F.col("linked"), F.col("n"))) / BLOCK_SHINGLES).alias("ps"),
        F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("qs")).where("size > 1 AND ps IS NOT NULL").drop("size")
    groups = written(groups, scratch_dir(spark, "groups"))
    rest = members.select("component", "class", "id", "text").join(groups, "component").join(
        apart.withColumn("apart", F.lit(True)), ["component", "class"], "left").withColumn("apart", F.coalesce("apart", F.lit(False)))
    others = _in_blocks(rest).groupBy("component", "p", "q").applyInPandas(_links_of_clusters(width, percent), "a long, b long")
    return linked.unionByName(others)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id, kept) per row; linked are sets with 100 * common >= percent * all.

    The defaults, shingles of five words and a similarity of 0.8, are those of near-duplicate stages.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    rows = written(sketches(docs, width), scratch_dir(spark, "sketches"))
    some = rows.where("n > 0 AND id IS NOT NULL")
    one = some.groupBy("n", "low", "high").agg(F.min(F.struct("id", "hash")).alias("of"), F.first("registers").alias("registers"))
    classes = written(one.select(F.monotonically_increasing_id().alias("class"), "n", "low", "high", "of.*", "registers"),
                      scratch_dir(spark, "classes"))
    copies = some.join(classes.select("n", "low", "high", F.col("id").alias("of")), ["n", "low", "high"]).where("id <> of")

    loose, links = _loose_clusters(classes, percent)
    exact = _exact_links(docs, classes, loose, links, width, percent)
    found = components(exact.unionByName(copies.select(F.col("of").alias("a"), F.col("id").alias("b"))))

    out = rows.select("id", F.col("n").alias("n_shingles")).join(
        found.select(F.col("id").alias("_id"), "component"), F.col("id") == F.col("_id"), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
