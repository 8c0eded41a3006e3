"""Operator 10 - near duplicates by MinHash with sequential Bayesian verification.

A document's set is its distinct shingles of ``shingle`` lower-cased words.
Documents with equal sets form a class at once (a 128-bit fingerprint of the
whole set); all further work is on one representative of each class.

1. Signatures of ``bands * rows`` hashes are banded; representatives that share
   a band are candidates.
2. Every candidate comparison reads the signatures in batches.  After each
   batch the posterior probability (uniform prior) that the similarity reaches
   the threshold is bounded; below ``miss`` the pair is dropped.
3. Survivors are verified on their full sets.

Candidates inside a band are not expanded into all pairs.  In a star round each
band compares one pivot with the members that are not yet in its component.
After ``star_rounds`` such rounds, bands that still hold several components
are compared in tiles of two bounded blocks: one of members outside the band's
largest component, one of all members.  Tiles hold signatures only; members with
a survivor go to their tile again with their full sets, and are verified there.
Every candidate pair of different components has then been compared, so no link
between components is lost, and a tile gives fewer links than it has members.

Components come from hooking smallest labels over the verified links, in
written rounds.

Scale: texts are never shuffled; signatures (4 bytes a hash) move once, pairs
grow with the number of copies and not with its square; hot bands and hot
pivots sit on the probe side of joins that AQE may split.

Defined results: a text without words (null, empty) has an empty set and is
linked with nothing; fewer words than a shingle make one shingle; every row is
judged by its own set, also where a ``doc_id`` occurs with several texts; rows
with a null ``doc_id`` count by their sets, but do not name a component (null if
it has no id at all; such rows are kept); pairs exactly at the threshold are
linked; a very long text is hashed whole, in a slice by itself; an empty table
gives no rows; other columns are ignored (``keep_one`` passes them on).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadweave.llm.tables import Workspace, small, without_rows
from threadweave.llm.textcols import MIX, id_text, lower_ascii, mix, slices, word_hashes, words


@dataclass(frozen=True)
class NearRules:
    """Shingle length in words, threshold as ``num / den``, bands and rows of the
    signature, hashes per verification batch, miss probability of pruning."""

    shingle: int = 5
    num: int = 80
    den: int = 100
    bands: int = 25
    rows: int = 5
    batch: int = 25
    miss: float = 1e-9
    star_rounds: int = 2
    block: int = 512

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted; and where each text's begin."""
    w = words(lower_ascii(texts))
    n = np.diff(w.starts)
    h = word_hashes(w.vocab)[w.codes] if len(w.codes) else np.zeros(0, np.uint64)
    owner, at = w.owner(), np.arange(len(w.codes))
    total = np.zeros(len(h), np.uint64)
    for j in range(k):  # words beyond the text's end count as nothing, so a short text is one shingle
        here = (at + j < w.starts[1:][owner]) if len(at) else np.zeros(0, bool)
        total = mix(total * MIX + np.where(here, h[np.minimum(at + j, max(len(h) - 1, 0))] | np.uint64(1), np.uint64(0)) + np.uint64(j))
    first = np.where(n[owner] >= k, at + k <= w.starts[1:][owner], at == w.starts[:-1][owner]) if len(at) else np.zeros(0, bool)
    total, owner = total[first], owner[first]
    order = np.lexsort((total, owner))
    total, owner = total[order], owner[order]
    new = np.ones(len(total), bool)
    new[1:] = (total[1:] != total[:-1]) | (owner[1:] != owner[:-1])
    starts = np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(n)))])
    return total[new], starts


def signatures(sets: np.ndarray, starts: np.ndarray, hashes: int) -> np.ndarray:
    """MinHash values (texts x hashes, uint32); texts without shingles get zeros."""
    out = np.zeros((len(starts) - 1, hashes), np.uint32)
    full = np.flatnonzero(np.diff(starts))
    if not len(full):
        return out
    odd = mix(np.arange(1, hashes + 1, dtype=np.uint64) * MIX) | np.uint64(1)
    begin = starts[full]
    for j in range(hashes):
        out[full, j] = np.minimum.reduceat(((sets * odd[j]) >> np.uint64(32)).astype(np.uint32), begin)
    return out


def min_matches(rules: NearRules) -> list[tuple[int, int]]:
    """(hashes read, least matches to go on) after each batch: with m matches of
    n, P(similarity >= t) = P(Binomial(n + 1, t) <= m)."""
    t, out = rules.num / rules.den, []
    for n in range(rules.batch, rules.hashes + 1, rules.batch):
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if below >= rules.miss:
                break
            m += 1
        out.append((n, m))
    return out


def _sketch(docs: DataFrame, rules: NearRules) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets, starts = shingle_sets(part["text"], rules.shingle)
            sig = signatures(sets, starts, rules.hashes)
            with np.errstate(over="ignore"):
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(v, dtype=np.uint64)]) for v in (mix(sets + MIX), mix(sets ^ MIX))]
            fp = [(s[starts[1:]] - s[starts[:-1]]).view(np.int64) for s in sums]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["mark"], pa.array(np.diff(starts)), pa.array(fp[0]), pa.array(fp[1]),
                 pa.array([x.tobytes() for x in sig], pa.binary())],
                ["doc_id", "mark", "n", "fp1", "fp2", "sig"])

    return id_text(docs, _mark().alias("mark")).mapInArrow(run, "doc_id long, mark string, n long, fp1 long, fp2 long, sig binary")


def _mark() -> Column:
    """Tells the texts of a ``doc_id`` apart."""
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _bands(reps: DataFrame, rules: NearRules) -> DataFrame:
    """(band key, number of the band, rep) for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b["sig"].to_pylist()), np.uint32).reshape(b.num_rows, rules.bands, rules.rows)
            key = np.arange(1, rules.bands + 1, dtype=np.uint64)[None, :] * MIX + np.zeros((b.num_rows, 1), np.uint64)
            for j in range(rules.rows):
                key = mix(key + sig[:, :, j].astype(np.uint64) * MIX)
            rep = np.repeat(b["rep"].to_numpy(zero_copy_only=False), rules.bands)
            nth = np.tile(np.arange(rules.bands, dtype=np.int32), b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(nth), pa.array(rep)], ["band", "nth", "rep"])

    return reps.select("rep", "sig").mapInArrow(run, "band long, nth int, rep long")


def _prune(pairs: DataFrame, rules: NearRules) -> DataFrame:
    """Pairs (a, b, sig_a, sig_b) whose posterior stays above the miss probability."""
    steps = min_matches(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b[c].to_pylist()), np.uint32).reshape(b.num_rows, -1) for c in ("sig_a", "sig_b"))
            live, same, done = np.arange(b.num_rows), np.zeros(b.num_rows, np.int64), 0
            for n, least in steps:
                same[live] += (x[live, done:n] == y[live, done:n]).sum(axis=1)
                live, done = live[same[live] >= least], n
            yield b.select(["a", "b"]).take(pa.array(live))

    return pairs.mapInArrow(run, "a long, b long")


def _verify(pairs: DataFrame, reps: DataFrame, docs: DataFrame, rules: NearRules, work: Workspace, name: str) -> tuple[DataFrame, int]:
    """Candidate pairs -> verified links, written."""
    sig = reps.select("rep", "sig")
    both = (pairs.join(sig.withColumnsRenamed({"rep": "a", "sig": "sig_a"}), "a")
            .join(sig.withColumnsRenamed({"rep": "b", "sig": "sig_b"}), "b"))
    left, n_left = work.write(_prune(both, rules), f"{name}-survivors")
    return _confirm(left, n_left, reps, docs, rules, work, name)


def _sets(docs: DataFrame, reps: DataFrame, ids: DataFrame, n_ids: int, rules: NearRules, work: Workspace, name: str) -> DataFrame:
    """(rep, members): the full shingle sets of the representatives ``ids``, each
    from a row with the id and the text of its class's first."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            h, starts = shingle_sets(part["text"], rules.shingle)
            yield pa.RecordBatch.from_arrays(
                [part["rep"], pa.array([h[i:j].tobytes() for i, j in zip(starts[:-1], starts[1:], strict=True)], pa.binary())],
                ["rep", "members"])

    rows, wanted = id_text(docs, _mark().alias("mark")), reps.join(small(ids, n_ids), "rep", "left_semi").select("rep", "first", "first_mark")
    same = F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("mark") == F.col("first_mark"))
    full = rows.join(small(wanted, n_ids), same).select("rep", "text")
    return work.write(full.mapInArrow(sets, "rep long, members binary").dropDuplicates(["rep"]), name)[0]


def _similar(x: np.ndarray, y: np.ndarray, rules: NearRules) -> bool:
    """Whether two sorted sets reach the threshold."""
    if rules.den * min(len(x), len(y)) < rules.num * max(len(x), len(y)):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    same = int((y[at] == x).sum())
    return rules.den * same >= rules.num * (len(x) + len(y) - same)


def _confirm(left: DataFrame, n_left: int, reps: DataFrame, docs: DataFrame, rules: NearRules, work: Workspace, name: str) -> tuple[DataFrame, int]:
    ids = left.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    full = _sets(docs, reps, ids, 2 * n_left, rules, work, f"{name}-sets")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            ok = [_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), rules)
                  for x, y in zip(part["members_a"], part["members_b"], strict=True)]
            yield part.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    pairs = (left.join(full.withColumnsRenamed({"rep": "a", "members": "members_a"}), "a")
             .join(full.withColumnsRenamed({"rep": "b", "members": "members_b"}), "b"))
    links = work.write(pairs.mapInArrow(exact, "a long, b long"), f"{name}-links")
    work.drop(f"{name}-sets")
    return links


def components(links: DataFrame, work: Workspace, name: str) -> tuple[DataFrame, int]:
    """(rep, comp) for each end of a link; comp is the smallest id reachable.

    Each round points every vertex at the smallest label among its neighbours
    and their labels, then follows labels twice; rounds are written tables."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")).distinct()
    edges, _ = work.write(both, f"{name}-edges")
    label, n = work.write(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("comp")).select(F.col("u").alias("rep"), "comp"),
                          f"{name}-label0")
    k = 0
    while n:
        k += 1
        near = (edges.join(small(label.select(F.col("rep").alias("v"), F.col("comp").alias("cv")), n), "v")
                .join(small(label.select(F.col("rep").alias("u"), F.col("comp").alias("cu")), n), "u"))
        # a vertex's label, and the label it points at, both take the smallest label seen
        hook = (near.select(F.explode(F.array(F.struct(F.col("u").alias("rep"), F.col("cv").alias("c")),
                                              F.struct(F.col("cu").alias("rep"), F.col("cv").alias("c")))).alias("x"))
                .select("x.*").groupBy("rep").agg(F.min("c").alias("c")))
        new = label.join(hook, "rep", "left").select("rep", F.least("comp", F.coalesce("c", "comp")).alias("comp"))
        jump = new.join(small(new.select(F.col("rep").alias("comp"), F.col("comp").alias("next")), n), "comp", "left") \
            .select("rep", F.coalesce(F.least("comp", "next"), "comp").alias("comp"))
        table, _ = work.write(jump, f"{name}-label{k}")
        changed = table.join(label.withColumnRenamed("comp", "old"), "rep").filter("comp <> old").limit(1).count()
        work.drop(f"{name}-label{k - 1}")
        label = table
        if not changed:
            break
    work.drop(f"{name}-edges")
    return label, n


def _with_comp(members: DataFrame, label: DataFrame | None, n: int) -> DataFrame:
    if label is None:
        return members.withColumn("comp", F.col("rep"))
    return (members.join(small(label, n), "rep", "left")
            .withColumn("comp", F.coalesce("comp", "rep")))


def _tiles(members: DataFrame, rules: NearRules) -> DataFrame:
    """Rows of ``members`` (band, rep, comp, main, size, probes) dealt to tiles
    (band, pb, hb) of one block of probes and one block of all members.

    Members outside the band's main component are probes: one goes with its
    probe block to all home blocks.  Every member goes with its home block to
    all probe blocks.  So each probe meets each member in one tile, and a tile
    holds about two blocks, whatever the band's size."""
    dealt = (members.withColumn("probe", F.col("comp") != F.col("main"))
             .withColumn("homes", F.greatest(F.ceil(F.col("size") / rules.block), F.lit(1)).cast("int"))
             .withColumn("lots", F.greatest(F.ceil(F.col("probes") / rules.block), F.lit(1)).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("rep"), "homes").cast("int"))
             .withColumn("lot", F.pmod(F.xxhash64("rep", F.lit(1)), "lots").cast("int")))
    as_home = F.transform(F.sequence(F.lit(0), F.col("lots") - 1), lambda x: F.struct(x.alias("pb"), F.col("own").alias("hb")))
    as_probe = F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda x: F.struct(F.col("lot").alias("pb"), x.alias("hb")))
    at = F.explode(F.when(F.col("probe"), F.array_union(as_home, as_probe)).otherwise(as_home)).alias("at")
    return (dealt.select(*members.columns, "own", "lot", "probe", at).select("*", "at.*").drop("at", "main", "size", "probes")
            .withColumn("probe", F.col("probe") & (F.col("lot") == F.col("pb"))).withColumn("home", F.col("own") == F.col("hb")).drop("own", "lot"))


class _Tile:
    """The members of a tile: which are probes, which at home, and what they are compared by."""

    def __init__(self, table: pa.Table, rules: NearRules):
        self.rules, self.steps = rules, min_matches(rules)
        self.rep, self.comp, self.n = (table[c].to_numpy() for c in ("rep", "comp", "n"))
        self.side, probe = table["side"].to_numpy(), table["probe"].to_numpy()
        self.probes, self.home = np.flatnonzero(probe), np.flatnonzero(table["home"].to_numpy())
        self.sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint32).reshape(len(self.rep), -1)
        before = table["nth"][0].as_py() * rules.rows
        self.earlier = self.sig[:, :before].reshape(len(self.rep), -1, rules.rows) if before else None

    def survivors(self, i: int, group: np.ndarray) -> np.ndarray:
        """Members at home that probe ``i`` may be near to, by set sizes and
        signatures, those with the most equal hashes first."""
        r, other = self.rules, self.home
        live = other[(group[other] != group[i]) & ((self.rep[other] < self.rep[i]) | ~self.side[other])]
        live = live[r.den * np.minimum(self.n[live], self.n[i]) >= r.num * np.maximum(self.n[live], self.n[i])]
        same, done = np.zeros(len(live), np.int64), 0
        for n, least in self.steps:
            same += (self.sig[live, done:n] == self.sig[i, done:n]).sum(axis=1)
            live, same, done = live[same >= least], same[same >= least], n
        if self.earlier is not None and len(live):
            first = ~(self.earlier[live] == self.earlier[i]).all(axis=2).any(axis=1)
            live, same = live[first], same[first]
        return live[np.argsort(-same, kind="stable")]


def _tile_survivors(tiles: DataFrame, rules: NearRules) -> DataFrame:
    """The rows of ``tiles`` (without signatures) that are in a pair which
    signatures do not rule out.  A tile gives at most its own rows."""

    def run(table: pa.Table) -> pa.Table:
        tile = _Tile(table, rules)
        keep = np.zeros(len(tile.rep), bool)
        for i in tile.probes.tolist():
            live = tile.survivors(i, tile.comp)
            keep[live] = True
            keep[i] |= len(live) > 0
        return table.drop_columns(["sig"]).filter(pa.array(keep))

    schema = tiles.drop("sig").schema
    return tiles.groupBy("band", "pb", "hb").applyInArrow(run, schema)


def _tile_links(tiles: DataFrame, rules: NearRules) -> DataFrame:
    """Verified links of the rows of ``tiles``, with ``sig`` and ``members``.  A
    tile skips pairs that its links so far have already joined, so it gives
    fewer links than it has members."""

    def run(table: pa.Table) -> pa.Table:
        tile = _Tile(table, rules)
        sets = [np.frombuffer(x, np.uint64) for x in table["members"].to_pylist()]
        _, group = np.unique(tile.comp, return_inverse=True)
        a_out, b_out = [], []
        for i in tile.probes.tolist():
            for j in tile.survivors(i, group).tolist():
                if group[i] != group[j] and _similar(sets[i], sets[j], rules):
                    a_out.append(min(tile.rep[i], tile.rep[j]))
                    b_out.append(max(tile.rep[i], tile.rep[j]))
                    group[group == group[j]] = group[i]
        return pa.table({"a": pa.array(a_out, pa.int64()), "b": pa.array(b_out, pa.int64())})

    return tiles.groupBy("band", "pb", "hb").applyInArrow(run, "a long, b long")


def _block_links(members: DataFrame, reps: DataFrame, docs: DataFrame, rules: NearRules, work: Workspace) -> tuple[DataFrame | None, int]:
    """Verified links of the bands that still hold several components.

    ``members``: band, nth, rep, comp, main (the band's largest component),
    size, probes.  Tiles compare signatures first; only members with a survivor
    go to their tile a second time, with their full sets.  A pair that shares an
    earlier band is left to that band, which is open as well."""
    sig = reps.select("rep", "n", "sig")
    # `side`: outside the main component, where a pair is in the lots of both its ends
    tiles = _tiles(members.withColumn("side", F.col("comp") != F.col("main")), rules).join(sig, "rep")
    left, n_left = work.write(_tile_survivors(tiles, rules), "open-survivors")
    if not n_left:
        return None, 0
    full = _sets(docs, reps, left.select("rep").distinct(), n_left, rules, work, "open-sets")
    found = work.write(_tile_links(left.join(reps.select("rep", "sig"), "rep").join(full, "rep"), rules).distinct(), "open-links")
    work.drop("open-survivors", "open-sets")
    return found


def _judged(docs: DataFrame, rules: NearRules, work: Workspace) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, mark) of every row."""
    sketch, _ = work.write(_sketch(docs, rules), "sketch")
    key = ["n", "fp1", "fp2"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("f")
    reps, _ = work.write(sketch.filter("n > 0").groupBy(*key).agg(first, F.first("sig").alias("sig"))
                         .select(*key, F.col("f.doc_id").alias("first"), F.col("f.mark").alias("first_mark"), "sig"), "classes")
    # a class goes by its smallest id, or by a number where ids do not tell classes apart
    numbered = reps.groupBy("first").agg(F.count(F.lit(1)).alias("k")).filter("k > 1 OR first IS NULL").limit(1).count() > 0
    reps = work.write(reps.withColumn("rep", F.monotonically_increasing_id()), "reps")[0] if numbered else reps.withColumn("rep", F.col("first"))
    bands, _ = work.write(_bands(reps, rules), "bands")
    size = bands.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("pivot")).filter("size > 1")
    members, n = work.write(bands.join(size, "band"), "members")
    work.drop("bands")
    links, label, n_label = None, None, 0
    for k in range(rules.star_rounds if n else 0):
        if k == 0:
            pairs = members.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b"))
        else:
            tagged = _with_comp(members.select("band", "rep"), label, n_label)
            salt = F.xxhash64("rep", F.lit(k))
            pivot = (tagged.groupBy("band").agg(F.min(F.struct(salt.alias("s"), "rep", "comp")).alias("p"),
                                                F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
                     .select("band", F.col("p.rep").alias("pivot"), F.col("p.comp").alias("pcomp")))
            pairs = (tagged.join(pivot, "band").filter("comp <> pcomp")
                     .select(F.least("pivot", "rep").alias("a"), F.greatest("pivot", "rep").alias("b")))
        candidates, n_pairs = work.write(pairs.distinct(), f"pairs{k}")
        if not n_pairs:
            break
        found, _ = _verify(candidates, reps, docs, rules, work, f"star{k}")
        links = found if links is None else links.unionByName(found)
        label, n_label = components(links, work, f"cc{k}")
    if n:
        tagged = _with_comp(members.select("band", "nth", "rep"), label, n_label)
        groups = tagged.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("g"))
        main = (groups.groupBy("band").agg(F.max(F.struct("g", "comp")).alias("m"), F.sum("g").alias("size"), F.count(F.lit(1)).alias("k"))
                .filter("k > 1 AND size > 2")
                .select("band", F.col("m.comp").alias("main"), "size", (F.col("size") - F.col("m.g")).alias("probes")))
        open_, n_open = work.write(tagged.join(main, "band"), "open")
        if n_open:
            found, n_found = _block_links(open_, reps, docs, rules, work)
            if n_found:
                links = found if links is None else links.unionByName(found)
                label, n_label = components(links, work, "cc")
    classes = _with_comp(reps.select(*key, "rep", "first"), label, n_label)
    if numbered:
        classes, _ = work.write(classes, "numbered")
        classes = classes.join(classes.groupBy("comp").agg(F.min("first").alias("name")), "comp").withColumn("comp", F.col("name"))
    out = sketch.select("doc_id", "mark", *key).join(classes.select(*key, "comp"), key, "left")
    comp = F.when(F.col("n") > 0, F.col("comp")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"), F.col("doc_id").eqNullSafe(comp).alias("kept"), "mark")


def near_duplicates(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return _judged(docs, rules, Workspace(docs.sparkSession, "near-dedup")).drop("mark")


def keep_one(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """The rows of ``docs`` (all columns) without those whose component keeps
    another document; rows with a null ``doc_id`` stay, and a row goes for its own
    text, not for another of its id."""
    work = Workspace(docs.sparkSession, "near-dedup")
    judged, _ = work.write(_judged(docs, rules, work).select("doc_id", "mark", "kept"), "judged")
    return without_rows(docs, judged, _mark(), work)
