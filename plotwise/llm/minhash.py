"""Near duplicates by HyperMinHash signatures, exact in what they link."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from plotwise.llm.components import components
from plotwise.llm.spark import ascii_lower, in_arrow, one_row_each, stored, unused
from plotwise.llm.words import grams, hash_strings, lists, mix, slices, split_words
from plotwise.operators import bloom

SHINGLE = 4
PERCENT = 80
BUCKET_BITS = 8
MANTISSA_BITS = 10
BAND = 6  # registers of a band: 42 bands; a pair at 0.8 shares none once in 300,000 pairs
MARGIN = 5.0  # standard deviations of the estimate that a candidate may lie below the threshold
BLOCK = 2048  # members of a family that are compared with as many others at once
LISTED = 160  # shingles; smaller sets show their shingles beside their registers


def shingle_sets(words, shingle: int):
    """Sorted distinct shingle hashes of each document; fewer words make one shingle."""
    hashes = hash_strings(words.vocabulary)[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    all_grams = grams(hashes, shingle)
    for a, b in zip(words.starts[:-1], words.starts[1:]):
        if b - a >= shingle:
            yield np.unique(all_grams[a : b - shingle + 1])
        elif b > a:
            yield grams(hashes[a:b], int(b - a)) ^ np.uint64(b - a)
        else:
            yield hashes[:0]


def registers(shingles: np.ndarray, bucket_bits: int = BUCKET_BITS, mantissa_bits: int = MANTISSA_BITS) -> np.ndarray:
    """HyperMinHash registers of a sorted set; 0 where a bucket is empty.

    A hash's first bits name its bucket; of the bucket's smallest rest the register keeps
    one more than the number of leading zeros, and the bits after the first one bit.
    """
    out = np.zeros(1 << bucket_bits, np.uint16)
    if not len(shingles):
        return out
    shingles = np.sort(mix(shingles))
    width = 64 - bucket_bits
    bucket = (shingles >> np.uint64(width)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    rest = shingles[first] & np.uint64((1 << width) - 1)
    length = np.zeros(len(rest), np.int64)  # of the rest in bits
    probe = rest.copy()
    for step in (32, 16, 8, 4, 2, 1):
        more = probe >= np.uint64(1 << step)
        length[more] += step
        probe[more] >>= np.uint64(step)
    length += (rest > 0).astype(np.int64)
    most = (1 << (16 - mantissa_bits)) - 2
    zeros = np.minimum(width - length, most)
    shift = length - 1 - mantissa_bits
    mantissa = np.where(
        shift >= 0, rest >> np.maximum(shift, 0).astype(np.uint64), rest << np.maximum(-shift, 0).astype(np.uint64)
    ) & np.uint64((1 << mantissa_bits) - 1)
    out[bucket[first]] = ((zeros + 1).astype(np.uint64) << np.uint64(mantissa_bits) | mantissa).astype(np.uint16)
    return out


@cache
def _lenders(n: int) -> np.ndarray:
    """For each register an order in which it asks the others."""
    rng = np.random.default_rng(17)
    return np.stack([rng.permutation(n) for _ in range(n)])


def densified(regs: np.ndarray, tries: int = 16) -> np.ndarray:
    """Registers without empty ones: an empty one shows what the first filled one it asks shows.

    All sets ask in the same order, so two sets' registers are equal as often as their
    shingles are shared, and a band of a short text still says six things.
    """
    filled = regs > 0
    if filled.all() or not filled.any():
        return regs
    out, lenders = regs.copy(), _lenders(len(regs))
    empty = np.flatnonzero(~filled)
    for start in range(0, len(regs), tries):
        asked = lenders[empty, start : start + tries]
        has = filled[asked]
        found = has.any(1)
        out[empty[found]] = regs[asked[found, has[found].argmax(1)]]
        empty = empty[~found]
        if not len(empty):
            break
    return out


@cache
def _factors(n: int, band: int) -> np.ndarray:
    return np.random.default_rng(5).integers(0, 2**64, (n, band), dtype=np.uint64) | np.uint64(1)


def bands(regs: np.ndarray, band: int = BAND) -> np.ndarray:
    """A key of every band of the densified registers; none of an empty set."""
    n = len(regs) // band
    if not regs.any():
        return np.zeros(0, np.uint64)
    rows = densified(regs)[: n * band].reshape(n, band).astype(np.uint64) + np.uint64(1)
    return mix((rows * _factors(n, band)).sum(1, dtype=np.uint64) + np.arange(1, n + 1, dtype=np.uint64))


def may_link(left: np.ndarray, right: np.ndarray, n_left, n_right, percent: int) -> np.ndarray:
    """Which pairs of registers (in rows) may reach the threshold.

    Jaccard is estimated from equal registers among those filled on either side, less the
    number expected to be equal by accident; a pair stays unless the estimate lies more
    than MARGIN standard deviations and a register below the threshold. Sets whose sizes
    rule the threshold out are dropped.
    """
    filled = ((left > 0) | (right > 0)).sum(1)
    equal = ((left == right) & (left > 0)).sum(1)
    accident = 0.169919 * left.shape[1] / (1 << MANTISSA_BITS) * np.minimum(filled / left.shape[1], 1.0)
    estimate = (equal - accident) / np.maximum(filled - accident, 1e-9)
    level = percent / 100
    low = level - MARGIN * np.sqrt(level * (1 - level) / np.maximum(filled, 1)) - 1 / np.maximum(filled, 1)
    sizes = 100 * np.minimum(n_left, n_right) >= percent * np.maximum(n_left, n_right)
    return sizes & (estimate >= low)


def _set_keys(sets: list) -> pa.Array:
    return pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets], pa.string())


SIGNED = "key long, n_shingles long, set_key string, registers binary, listed binary, bands array<long>"


def _sign(shingle: int, band: int):
    def read(batches):
        for part in slices(batches):
            sets = list(shingle_sets(split_words(part.column("text")), shingle))
            signs = [registers(s) for s in sets]
            keys = [bands(r, band) for r in signs]
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _set_keys(sets),
                    pa.array([r.tobytes() for r in signs], pa.binary()),
                    pa.array([listed(s) for s in sets], pa.binary()),
                    lists(np.concatenate(keys).view(np.int64), offsets, pa.int64()),
                ],
                ["key", "n_shingles", "set_key", "registers", "listed", "bands"],
            )

    return read


def _sets(shingle: int):
    def read(batches):
        for part in slices(batches):
            sets = list(shingle_sets(split_words(part.column("text")), shingle))
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            values = np.concatenate(sets).view(np.int64)
            yield pa.RecordBatch.from_arrays([_set_keys(sets), lists(values, offsets, pa.int64())], ["set_key", "shingles"])

    return read


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def _estimated(percent: int):
    def read(batches):
        for batch in batches:
            if batch.num_rows:
                ok = may_link(
                    _matrix(batch.column("left")),
                    _matrix(batch.column("right")),
                    batch.column("n_a").to_numpy(),
                    batch.column("n_b").to_numpy(),
                    percent,
                )
                yield batch.filter(pa.array(ok)).select(["a", "b"])

    return read


def listed(shingles: np.ndarray) -> bytes | None:
    """32-bit forms of a small set's shingles, sorted: where both sides have them, no estimate is needed."""
    return np.unique((shingles >> np.uint64(32)).astype(np.uint32)).tobytes() if len(shingles) <= LISTED else None


class Lists:
    """Shingles of many small sets, one after another."""

    def __init__(self, lists: list):
        self.known = np.array([x is not None for x in lists])
        each = [np.frombuffer(x or b"", np.uint32) for x in lists]
        self.lengths = np.array([len(x) for x in each], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.values = np.concatenate(each) if each else np.zeros(0, np.uint32)
        self.each = each

    def may_reach(self, i: int, others: np.ndarray, n_i: int, n_others: np.ndarray, percent: int) -> np.ndarray:
        """Which of the others, all listed, may reach the threshold with set i: shared forms are counted.

        Two shingles of one form count as equal, so no pair is lost.
        """
        own = self.each[i]
        at = np.minimum(np.searchsorted(own, self.values), len(own) - 1)
        total = np.concatenate([[0], np.cumsum(own[at] == self.values)])
        starts = self.ends[others] - self.lengths[others]
        # forms may be fewer than shingles; what they hide may be shared
        common = total[self.ends[others]] - total[starts] + (n_i - len(own))
        return 100 * common >= percent * (n_i + n_others - common)


def shared_bound(n_left, n_right, own_left, own_right, percent: int) -> np.ndarray:
    """Which pairs may reach the threshold given shingles that no other candidate has.

    Such a shingle is in no intersection, so the intersection is at most the smaller rest.
    """
    most = np.minimum(n_left - own_left, n_right - own_right)
    return 100 * most >= percent * (n_left + n_right - most)


def _compared(percent: int):
    """A block of a family's small components beside a block of all of it: pairs across components.

    Rows come sorted by (family, i, j); side 0 is the small block, side 1 the other. A block
    is at most a few hundred rows.
    """

    def compare(rows):
        keys = np.array([r["key"] for r in rows])
        part = np.array([r["component"] for r in rows])
        size = np.array([r["n_shingles"] for r in rows])
        alone = np.array([r["own"] for r in rows])
        small = np.array([r["small"] for r in rows])
        side = np.array([r["side"] for r in rows])
        regs = np.frombuffer(b"".join(r["registers"] for r in rows), np.uint16).reshape(len(rows), -1)
        sets = Lists([r["listed"] for r in rows])
        for i in np.flatnonzero(side == 0):
            others = np.flatnonzero(
                (side == 1)
                & (part != part[i])
                & (~small | (keys > keys[i]))  # two small ones meet twice
                & shared_bound(size[i], size, alone[i], alone, percent)
            )
            if not len(others):
                continue
            ok = may_link(regs[i][None, :], regs[others], size[i], size[others], percent)
            if sets.known[i]:
                both = sets.known[others]
                ok[both] = sets.may_reach(i, others[both], size[i], size[others[both]], percent)
            for j in others[ok]:
                yield min(keys[i], keys[j]), max(keys[i], keys[j])

    def made(rows):
        pairs = list(compare(rows))
        return pa.RecordBatch.from_arrays(
            [pa.array([int(p[k]) for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"]
        )

    def read(batches):
        group, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                own = (row["family"], row["i"], row["j"])
                if own != group and rows:
                    yield made(rows)
                    rows = []
                group = own
                rows.append(row)
        if rows:
            yield made(rows)

    return read


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("right"))
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("left"))
    common = F.size(F.array_intersect("left", "right"))
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .withColumn("common", common)
        .filter(100 * F.col("common") >= percent * (F.size("left") + F.size("right") - F.col("common")))
        .select("a", "b")
    )


def _across(
    buckets: DataFrame, found: DataFrame, slim: DataFrame, sets: DataFrame, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b) of different components that share a bucket's family, and those families' sets."""
    placed = buckets.join(found.withColumnRenamed("node", "key"), "key", "left").select(
        "band", "key", F.coalesce("component", "key").alias("component")
    )
    mixed = placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("key").alias("first")
    )
    placed = stored(placed.join(mixed.filter("low < high").select("band", "first"), "band"), "minhash-open")
    # a document is linked with one of its buckets' firsts, and these with one another: the
    # families are those of all buckets, and a document in forty buckets is not forty links
    firsts = placed.groupBy("key").agg(F.collect_set("first").alias("firsts"))
    firsts = firsts.select("key", "firsts", F.array_min("firsts").alias("a"))
    between = firsts.select("a", F.explode("firsts").alias("b")).distinct()
    family = components(firsts.select("a", F.col("key").alias("b")).union(between))
    members = (
        placed.select("key", "component")
        .distinct()
        .join(family.select(F.col("node").alias("key"), F.col("component").alias("family")), "key")
    )
    sets = stored(sets.join(members.select("key"), "key", "left_semi"), "minhash-family-sets")
    each = sets.select("key", F.explode("shingles").alias("h"))
    own = (
        each.groupBy("h")
        .agg(F.count("*").alias("n"), F.min("key").alias("key"))
        .filter("n = 1")
        .groupBy("key")
        .agg(F.count("*").alias("own"))
    )
    members = (
        members.join(slim.select("key", "n_shingles"), "key")
        .join(own, "key", "left")
        .withColumn("own", F.coalesce("own", F.lit(0)))
        .filter(100 * (F.col("n_shingles") - F.col("own")) >= percent * F.col("n_shingles"))
    )
    # what a document shares, and the smallest partner it could have, bound what it can reach
    smallest = members.groupBy("family").agg(F.min("n_shingles").alias("smallest"))
    rest = F.col("n_shingles") - F.col("own")
    members = members.join(smallest, "family").filter(
        100 * rest >= percent * (F.col("n_shingles") + F.greatest("smallest", rest) - rest)
    )
    members = stored(members.drop("smallest"), "minhash-members")
    sizes = members.groupBy("family", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("family").agg(
        F.sum("n").alias("all"), F.max("n").alias("most"), F.max_by("component", "n").alias("largest")
    )
    largest = largest.filter(F.col("all") > F.col("most")).select(
        "family",
        "largest",
        F.ceil(F.col("all") / BLOCK).cast("int").alias("wide"),
        F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int").alias("high"),
    )
    members = members.join(largest, "family").withColumn("small", F.col("component") != F.col("largest"))
    columns = ["family", "i", "j", "side", "key", "component", "n_shingles", "own", "small"]
    upper = members.filter("small").withColumn("side", F.lit(0))
    upper = upper.withColumn("i", F.pmod(F.xxhash64("key"), F.col("high")).cast("int")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("wide") - 1))
    )
    other = members.withColumn("side", F.lit(1))
    other = other.withColumn("j", F.pmod(F.xxhash64("key", "family"), F.col("wide")).cast("int")).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.col("high") - 1))
    )
    blocks = (
        upper.select(*columns)
        .unionByName(other.select(*columns))
        .join(slim.select("key", "registers", "listed"), "key")
        .repartition("family", "i", "j")
        .sortWithinPartitions("family", "i", "j")
    )
    return in_arrow(blocks, _compared(percent), "a long, b long").distinct(), sets


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    band: int = BAND,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when their sets of distinct `shingle`-word shingles (A-Z lower-cased)
    share `percent` of their union; component_id is the smallest id reachable. A shorter
    text is one shingle, a text without words is linked with nothing.

    1. Every text becomes 256 HyperMinHash registers of 16 bits. Equal sets are one from
       here on.
    2. Documents that share a band of registers share a bucket. Every document is compared
       with the most central one in its buckets (whose own buckets hold most members),
       which joins large groups with one pair per member; estimate, then check on full sets.
    3. Buckets that still hold several components make families. In each, members of all
       components but the largest are compared with all members of other components, in
       blocks of registers (small sets: of their shingles). Nothing leaves a block but pairs that may reach the threshold,
       by the estimate and by the shingles that a document shares with no other candidate;
       they are checked on full sets too. So no candidate is left out, and a group of
       copies never becomes all its pairs.

    Null ids are linked with nothing and kept. Every distinct set is a node, so rows that repeat
    an id with different texts link what each of them is near to; the id itself joins its
    own sets. Other columns are ignored. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("key"), ascii_lower(F.col(text_col)).alias("text"))
    signed = stored(in_arrow(rows, _sign(shingle, band), SIGNED), "minhash-signed")
    usable = signed.filter("key is not null and set_key is not null")
    # a node is a distinct set, named by a number; one document that has it stands for all
    nodes = usable.groupBy("set_key").agg(
        F.min("key").alias("least"),
        F.first(F.struct("n_shingles", "registers", "listed", "bands")).alias("sign"),
    )
    nodes = stored(nodes.withColumn("key", F.monotonically_increasing_id()), "minhash-nodes")
    slim = nodes.select("key", "sign.n_shingles", "sign.registers", "sign.listed")

    members = nodes.select("key", F.explode("sign.bands").alias("band"))
    counts = members.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = stored(members.join(counts, "band"), "minhash-buckets")
    central = buckets.groupBy("key").agg(F.sum("n").alias("mass"))
    # among equal masses the hash decides, as it would in any order
    rank = F.col("mass") * (1 << 20) + F.pmod(F.xxhash64("key"), F.lit(1 << 20))
    hubs = buckets.join(central, "key").groupBy("band").agg(F.max_by("key", rank).alias("hub"), F.max(rank).alias("rank"))
    involved = nodes.select("key", "set_key", "least").join(central.select("key"), "key", "left_semi")
    # most texts share no bucket: a Bloom filter over the wanted ids drops those in the scan, so they are not shuffled
    wanted = stored(involved.select(F.col("least").alias("key")).distinct(), "minhash-wanted")
    bits = bloom.bits_for(wanted.count())
    held = rows if bits is None else bloom.where_may_hold(rows, "key", bloom.filter_words(wanted, "key", bits), bits)
    texts = held.join(wanted, "key", "left_semi")
    sets = in_arrow(texts, _sets(shingle), "set_key string, shingles array<long>")
    # a document read for one of its texts shows all of them; a set counts once
    sets = sets.join(involved.select("set_key", "key"), "set_key").groupBy("key").agg(F.first("shingles").alias("shingles"))
    sets = stored(sets, "minhash-sets")

    stars = (
        buckets.join(hubs, "band")
        .filter("hub <> key")
        .groupBy("key")
        .agg(F.max_by("hub", "rank").alias("hub"))
        .select(F.least("hub", "key").alias("a"), F.greatest("hub", "key").alias("b"))
        .distinct()
    )
    stars = stars.join(slim.drop("listed").toDF("b", "n_b", "right"), "b")
    stars = stars.join(slim.drop("listed").toDF("a", "n_a", "left"), "a")
    stars = in_arrow(stars, _estimated(percent), "a long, b long")
    links = stored(_verified(stars, sets, percent), "minhash-links")
    found = components(links)
    pairs, family_sets = _across(buckets, found, slim, sets, percent)
    more = stored(_verified(pairs, family_sets, percent), "minhash-more")

    of_id = usable.select("key", "set_key").join(nodes.select("set_key", F.col("key").alias("node")), "set_key")
    of_id = stored(of_id.select("key", "node").distinct(), "minhash-of-id")
    first = of_id.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("last")).filter("a < last")
    same_id = stored(of_id.join(first.select("key", "a"), "key").filter("a < node").select("a", F.col("node").alias("b")), "minhash-same-id")
    if not more.isEmpty() or not same_id.isEmpty():
        found = components(links.union(more).union(same_id))
    placed = nodes.select("key", "least").join(found.withColumnRenamed("node", "key"), "key", "left")
    placed = placed.select(F.col("key").alias("node"), "least", F.coalesce("component", "key").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("least").alias("smallest"))
    of_id = of_id.groupBy("key").agg(F.min("node").alias("node"))  # an id's sets lie in one component
    named = of_id.join(placed.select("node", "component"), "node").join(smallest, "component").select("key", "smallest")
    return (
        signed.select("key", "n_shingles")
        .join(named, "key", "left")
        .select(F.col("key").alias("doc_id"), "n_shingles", F.coalesce("smallest", "key").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group, all its columns unchanged.

    Rows that repeat an id are one document, of which one row stays; rows with a null id are
    linked with nothing, and all stay. Clashing column names do no harm.
    """
    found = near_duplicates(docs, id_col, text_col, **options).filter("doc_id is not null")
    ids = found.groupBy("doc_id").agg(F.count("*").alias("rows"), F.bool_or("kept").alias("kept"))
    # the few ids that go, or repeat, are looked up, not the many that stay
    special = stored(ids.filter("rows > 1 or not kept"), "minhash-special")
    name = unused(docs, "_special_id")

    def by_id(ids: DataFrame, how: str) -> DataFrame:
        return docs.join(ids.select(F.col("doc_id").alias(name)), F.col(id_col) == F.col(name), how)

    out = by_id(special, "left_anti")
    often = special.filter("kept")
    return out if often.isEmpty() else out.unionByName(one_row_each(by_id(often, "left_semi"), [id_col]))
