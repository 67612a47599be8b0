"""N-gram Jaccard join with token-combination prefixes.

Documents are sets of distinct word shingles.  All sets of sizes [2**b, 2**(b+1))
and the smaller ones that can still reach the threshold with them meet in band
``b``.  In a band every token (shingle) has one place in a global order: first
the rare tokens of a fixed slice of the hash space, then that slice's frequent
tokens, then all others, each part by hash.  "Frequent" means found in
``frequent`` or more sets of the band.  Walking a set in this order, a rare
token covers one token and is indexed alone; a frequent one is indexed in
pairs with the others of its hash class and covers one token less per class.
The prefix is extended until it covers one token more than a partner may lack.
Two sets that reach the threshold then share an indexed token or pair, so the
index loses no link.  Candidates pass two exact bounds (size, and the parity
bitmap, whose differing bits bound the symmetric difference from below) and
are verified on the whole sets.

Exact copies are one set.  Groups of near copies are not expanded: first each
index entry is tried against its smallest document only.  Where that leaves
several components in an entry of many documents, these meet in small random
cells, dealt anew as long as that connects many of them, so a dense group
becomes one component by a number of pairs in proportion to its size.  Then
only documents that are still in different components meet, each with all
others, and those that share many entries in few of them.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import bound_batches, discard, filter_by_keys, publish, row_blocks, text_buffers
from tidemart.llm.components import components
from tidemart.llm.textkernel import mix, shingle_sets

#: Longs of the folded parity bits that every candidate pair is tried with.
MASK = 16
#: Open entries of a row in which it may meet a partner before others are passed over.
EARLY = 16
#: Rows beyond which an open entry's rows first meet in random cells, the rows of a cell on average,
#: and in how many of its entries a row is dealt to one.
CROWD, CELL, DEALT = 32, 8, 4
#: Slices of the tokens (by hash) that are counted one after another: the shuffles of one lie on disk at a time.
SLICES = 4
SIGNATURE = ("n int, fp binary, bits array<bigint>, m array<bigint>, toks array<bigint>, "
             "bands array<struct<b:int,u:int>>")


def allowed_missing(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` that a partner at the threshold may lack."""
    return n - -(-percent * n // 100)


def linkable(n: int, percent: int) -> bool:
    """Whether a set of ``n`` tokens can reach the threshold with a different set."""
    return 100 * n // percent > n or 100 * (n - 1) >= percent * (n + 1)


def classes_of(band: int, percent: int) -> int:
    """Hash classes of frequent tokens: about four tokens of a prefix fall in one."""
    return max(1, (100 - percent) * 2**band // 400)


def slice_of(band: int, percent: int) -> float:
    """Share of the hash space whose tokens come first in a band's order."""
    return min(1.0, 1.15 * (100 - percent) / 100 + 12 / 2**band)


def _band_regions(tokens: np.ndarray, percent: int) -> tuple[int, list[dict]]:
    """How many tokens (by hash) the index may need, and for each band how many
    of them lie in the band's slice."""
    n = len(tokens)
    if not linkable(n, percent):
        return 0, []
    keep, bands = 0, []
    for b in range(n.bit_length() - 1, (100 * n // percent).bit_length()):
        share = slice_of(b, percent)
        inside = n if share >= 1 else int(np.searchsorted(tokens, np.uint64(int(share * 2.0**64))))
        need = allowed_missing(n, percent) + 1 + classes_of(b, percent)
        keep = max(keep, inside, min(n, need))
        bands.append({"b": b, "u": inside})
    return keep, bands


def _parity(tokens: np.ndarray) -> np.ndarray:
    """Parity bits as longs; at least 1,024 bits, and at least as many as tokens: sets somewhat below the
    threshold differ in clearly more bits than linked ones may."""
    width = max(64 * MASK, 1 << len(tokens).bit_length())
    odd = np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n, fp, bits, toks, bands) for each row of ``docs``."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            data, offsets = text_buffers(batch.column("text"))
            for i, j in row_blocks(offsets):
                rows = {"n": [], "fp": [], "bits": [], "m": [], "toks": [], "bands": []}
                block = offsets[i : j + 1]
                for tokens in shingle_sets(data[block[0] : block[-1]], block - block[0], words):
                    keep, bands = _band_regions(tokens, percent)
                    rows["n"].append(len(tokens))
                    rows["fp"].append(xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None)
                    bits = _parity(tokens) if keep else None
                    rows["bits"].append(bits)
                    rows["m"].append(np.bitwise_xor.reduce(bits.reshape(-1, MASK)) if keep else None)
                    rows["toks"].append(tokens[:keep].view(np.int64))
                    rows["bands"].append(bands)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(rows["n"], pa.int32()), pa.array(rows["fp"], pa.binary()),
                     pa.array(rows["bits"], pa.list_(pa.int64())), pa.array(rows["m"], pa.list_(pa.int64())),
                     pa.array(rows["toks"], pa.list_(pa.int64())),
                     pa.array(rows["bands"], pa.list_(pa.struct([("b", pa.int32()), ("u", pa.int32())])))],
                    ["doc_id", *rows])

    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, f"doc_id bigint, {SIGNATURE}")


def _alone(rank, tok, df, n, percent, frequent) -> np.ndarray:
    """Index entries of a set whose slice holds enough rare tokens: those of
    its first rare tokens that other sets have too."""
    order = np.argsort(rank)
    rank, tok, df = rank[order], tok[order], df[order]
    common = df >= frequent
    place = rank - (np.cumsum(common) - common)  # among the set's rare tokens
    return tok[~common & (place <= allowed_missing(n, percent))]


def _with_pairs(toks, inside, rank, df, n, band, percent, frequent) -> np.ndarray:
    """Index entries of a set that must also use frequent tokens, in pairs."""
    first, tail = toks[:inside], toks[inside:]
    count = np.ones(inside, np.int64)
    count[rank] = df
    rare = count < frequent
    alone, rest = first[rare], np.concatenate([first[~rare], tail])
    kind = (mix(rest) % np.uint64(classes_of(band, percent))).astype(np.int64)
    again = np.ones(len(rest), bool)
    again[np.unique(kind, return_index=True)[1]] = False
    stop = int(np.searchsorted(np.cumsum(again), allowed_missing(n, percent) + 1 - len(alone))) + 1
    rest, kind = rest[:stop], kind[:stop]
    keys = [alone[count[rare] > 1]]
    for c in np.unique(kind):
        own = rest[kind == c]
        i, j = np.triu_indices(len(own), 1)
        keys.append(mix(own[i] * np.uint64(3) + mix(own[j])))
    return np.concatenate(keys)


def _lists(batch, names) -> dict:
    """For list columns, a function from the row number to its values; a null is empty."""
    def part(column):
        flat = column.flatten().to_numpy(zero_copy_only=False)
        size = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        end = np.cumsum(size)
        return lambda r: flat[end[r] - size[r] : end[r]]

    return {c: part(batch.column(c)) for c in names}


def _emit(entries):
    """Record batches (b, sig, id, n) from (b, id, n, keys) tuples."""
    entries = [e for e in entries if len(e[3])]
    if entries:
        sizes = [len(e[3]) for e in entries]
        b, i, n = (np.repeat([e[k] for e in entries], sizes) for k in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(b.astype(np.int32)), pa.array(np.concatenate([e[3] for e in entries]).view(np.int64)),
             pa.array(i.astype(np.int64)), pa.array(n.astype(np.int32))], ["b", "sig", "id", "n"])


def _entries(sets: DataFrame, percent: int, frequent: int) -> DataFrame:
    """Index entries (b, sig, id, n) of all sets in all their bands."""
    by_band = sets.select("row", "id", "n", "toks", F.inline("bands"))
    occurs = by_band.filter("u > 0").select("row", "b", F.posexplode(F.slice("toks", 1, F.col("u"))).alias("rank", "tok"))
    found = []
    for k in range(SLICES):
        part = occurs.filter(F.pmod("tok", F.lit(SLICES)) == k)
        shared = publish(part.groupBy("b", "tok").agg(F.count("*").alias("df")).filter("df > 1"), "jaccard-df")
        found.append(publish(part.join(shared, ["b", "tok"]).select("row", "b", "rank", "tok", "df"), "jaccard-shared"))
        discard(shared)
    hits = (reduce(DataFrame.unionByName, found).groupBy("row", "b")
            .agg(F.collect_list(F.struct("rank", "tok", "df")).alias("hits")))
    need = F.expr(f"n - ({percent} * n + 99) div 100 + 1")
    rare = F.expr(f"u - coalesce(size(filter(hits, h -> h.df >= {frequent})), 0)")
    ranked = publish(by_band.drop("toks").join(hits, ["row", "b"], "left").withColumn("enough", rare >= need), "jaccard-hits")
    for done in found:
        discard(done)
    parts = ["row", "id", "n", "b", "u", "hits.rank", "hits.tok", "hits.df"]

    def alone(batches):
        for batch in batches:
            at = _lists(batch, ("rank", "tok", "df"))
            rows = zip(*(batch.column(c).to_pylist() for c in ("b", "id", "n")))
            yield from _emit([(b, i, n, _alone(at["rank"](r), at["tok"](r), at["df"](r), n, percent, frequent).view(np.uint64))
                              for r, (b, i, n) in enumerate(rows)])

    def paired(batches):
        for batch in batches:
            at = _lists(batch, ("rank", "df", "toks"))
            rows = zip(*(batch.column(c).to_pylist() for c in ("b", "id", "n", "u")))
            yield from _emit([(b, i, n, _with_pairs(at["toks"](r).view(np.uint64), u, at["rank"](r).astype(np.int64),
                                                    at["df"](r), n, b, percent, frequent))
                              for r, (b, i, n, u) in enumerate(rows)])

    schema = "b int, sig bigint, id bigint, n int"
    easy = ranked.filter("enough AND hits IS NOT NULL").select(*parts).mapInArrow(alone, schema)
    hard = ranked.filter("NOT enough")
    rows = publish(hard.select("row").distinct(), "jaccard-hard")
    toks = filter_by_keys(sets.select("row", "toks"), rows, ["row"], "left_semi")
    entries = publish(easy.unionByName(hard.select(*parts).join(toks, "row").mapInArrow(paired, schema)), "jaccard-index")
    for done in (ranked, rows):
        discard(done)
    return entries


def _size_bound(percent: int, x: str, y: str) -> str:
    return f"100 * least({x}, {y}) >= {percent} * greatest({x}, {y})"


def _parity_bound(percent: int, differing: str, x: str, y: str) -> str:
    """Differing parity bits against the largest symmetric difference at the threshold."""
    return f"({differing}) * {100 + percent} <= {100 - percent} * ({x} + {y})"


def _sketched(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that size and parity bits of the whole sets allow."""
    one = sketches.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    two = sketches.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
    both = pairs.join(one, "a").join(two, "b").filter(_size_bound(percent, "na", "nb"))
    fold = "if(size({0}) > size({1}), zip_with(slice({0}, 1, size({1})), slice({0}, size({1}) + 1, size({1})), (p, q) -> p ^ q), {0})"
    differing = f"aggregate(zip_with({fold.format('ba', 'bb')}, {fold.format('bb', 'ba')}, (p, q) -> bit_count(p ^ q)), 0, (s, v) -> s + v)"
    return both.filter(_parity_bound(percent, differing, "na", "nb")).select("a", "b").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    ids = publish(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "jaccard-ids")

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for i, j in row_blocks(offsets):
                block = offsets[i : j + 1]
                sets = shingle_sets(data[block[0] : block[-1]], block - block[0], words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    ["doc_id", "s"])

    wanted = filter_by_keys(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), ids, ["doc_id"], "left_semi")
    sets = publish(wanted.mapInArrow(run, "doc_id bigint, s array<bigint>"), "jaccard-sets")
    both = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    linked = publish(both.select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb")).alias("total"))
                     .filter(F.expr(f"100 * common >= {percent} * (total - common)")).select("a", "b"), "jaccard-links")
    for done in (ids, sets):
        discard(done)
    return linked


def _mixed(live: DataFrame) -> DataFrame:
    """(b, sig, top, c): largest component and number of rows of each entry that holds several components."""
    return (live.groupBy("b", "sig", "comp").agg(F.count("*").alias("c"))
            .groupBy("b", "sig").agg(F.max_by("comp", F.struct("c", "comp")).alias("top"), F.sum("c").alias("c"), F.count("*").alias("comps"))
            .filter("comps > 1").drop("comps"))


def _merged(links: DataFrame, label: DataFrame) -> DataFrame:
    """(node, component) of the components in ``label`` that ``links`` connect."""
    ends = (links.join(label.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
            .join(label.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left"))
    return publish(components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))), "jaccard-merged")


def _relabeled(rows: DataFrame, merged: DataFrame) -> DataFrame:
    new = merged.select(F.col("node").alias("comp"), "component")
    return rows.join(new, "comp", "left").withColumn("comp", F.coalesce("component", "comp")).drop("component")


def _cell_links(live: DataFrame, label: DataFrame, sets: DataFrame, masks: DataFrame, bounds: str,
                docs: DataFrame, words: int, percent: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Verified links (a, b) between rows of different components that fall into one cell of a crowded
    entry, and what they merge; None if no entry is crowded.  The pairs this misses are left to the
    comparison of all."""
    crowded = publish(_mixed(live).filter(f"c > {CROWD}").select("b", "sig"), "jaccard-crowded")
    if not crowded.limit(1).count():
        return None, None
    dealt = (live.join(crowded, ["b", "sig"], "left_semi").groupBy("id", "b", "n", "comp")
             .agg(F.slice(F.array_sort(F.collect_set("sig")), 1, DEALT).alias("sigs")))
    crowd = publish(dealt.select("id", "b", "n", "comp", F.explode("sigs").alias("sig")), "jaccard-crowd")
    links, merged, known, now, seed = None, None, 0, crowd, 0
    while True:
        cell = F.pmod(F.xxhash64("id", "sig", F.lit(seed)), F.ceil(F.col("c") / CELL))
        cells = publish(now.join(_mixed(now), ["b", "sig"]).withColumn("cell", cell).join(masks, "id"), "jaccard-cells")
        rows = cells.select("id").distinct().count()
        if not rows:
            return links, merged
        pairs = (cells.alias("x").join(cells.alias("y"), F.expr(
            f"x.b = y.b AND x.sig = y.sig AND x.cell = y.cell AND x.comp <> y.comp AND x.id < y.id AND {bounds}"))
            .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())
        near = publish(pairs, "jaccard-met")
        pairs = publish(_sketched(near, sets, percent), "jaccard-met")
        for done in (cells, near):
            discard(done)
        new = _verified(pairs, docs, words, percent)
        links = new if links is None else links.unionByName(new)
        merged = _merged(links, label)
        nodes = merged.count()
        if 10 * (nodes - known) < rows:
            return links, merged
        known, now, seed = nodes, _relabeled(crowd, merged), seed + 1


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, frequent: int = 24) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs(doc_id, text)``.

    Two documents link when 100 * intersection >= percent * union of their
    shingle sets (percent from 80 to 100).  Words are split at ASCII white
    space, A-Z folded; texts of fewer than ``words`` words are one shingle.
    component_id is the smallest doc_id reachable by links, itself included.
    Null and empty texts have n_shingles 0 and link with nothing.  Rows with a
    null doc_id link like any other, each for itself; a component without a
    doc_id has the component_id null.  Repeated rows stay; rows of one doc_id
    count as one document.  Other columns are ignored; an empty table gives an
    empty result.  The result has classes only: rows that are in one component
    already are not compared any more, so links aren't counted.
    """
    if not 80 <= percent <= 100:
        raise ValueError("percent must be from 80 to 100")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if docs.filter("doc_id IS NULL").limit(1).count():
        return _with_null_ids(docs, words, percent, frequent)
    signed = publish(signatures(docs, words, percent).withColumn("row", F.monotonically_increasing_id()), "jaccard-sets")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row")).alias("f")
    copies = publish(signed.filter("fp IS NOT NULL").groupBy("fp").agg(first, F.count("*").alias("copies"))
                     .filter("copies > 1").select("fp", F.col("f.doc_id").alias("rep"), F.col("f.row").alias("kept")), "jaccard-copies")
    rows = publish(signed.select("doc_id", "row", "n", "fp").join(copies, "fp", "left")
                   .select("doc_id", "row", "n", F.coalesce("rep", "doc_id").alias("rep"), "kept"), "jaccard-reps")
    others = publish(rows.filter("row <> kept").select("row"), "jaccard-others")
    sets = filter_by_keys(signed.filter("size(bands) > 0 AND doc_id IS NOT NULL"), others, ["row"], "left_anti")
    sets = sets.withColumnRenamed("doc_id", "id")

    entries = _entries(sets, percent, frequent)
    sketches = publish(sets.select("id", "n", "bits", "m"), "jaccard-sketches")
    for done in (signed, copies, others):
        discard(done)
    heads = publish(entries.groupBy("b", "sig").agg(F.min("id").alias("a"), F.count("*").alias("c")).filter("c > 1"), "jaccard-heads")
    led = publish(heads.join(entries.withColumnRenamed("id", "b_"), ["b", "sig"]).filter("a < b_")
                  .select("a", F.col("b_").alias("b")).distinct(), "jaccard-stars")
    stars = publish(_sketched(led, sketches, percent), "jaccard-stars")
    discard(led)
    links = _verified(stars, docs, words, percent)
    label = publish(components(links), "jaccard-label")

    # What is left: entries that still hold more than one component; their rows
    # outside the entry's largest component meet the rows of other components.
    live = (entries.join(heads.select("b", "sig"), ["b", "sig"], "left_semi")
            .join(label.withColumnRenamed("node", "id"), "id", "left")
            .select("b", "sig", "id", "n", F.coalesce("component", "id").alias("comp")))
    live = publish(live, "jaccard-live")
    for done in (entries, heads):
        discard(done)
    masks = sketches.select("id", *(F.col("m")[k].alias(f"m{k}") for k in range(MASK)))
    differing = " + ".join(f"bit_count(x.m{k} ^ y.m{k})" for k in range(MASK))
    bounds = f"{_size_bound(percent, 'x.n', 'y.n')} AND {_parity_bound(percent, differing, 'x.n', 'y.n')}"
    met, merged = _cell_links(live, label, sketches, masks, bounds, docs, words, percent)
    if met is not None:
        old, live = live, publish(_relabeled(live, merged), "jaccard-live")
        discard(old)
    mixed = publish(_mixed(live).drop("c"), "jaccard-mixed")
    open_ = publish(live.join(mixed, ["b", "sig"]), "jaccard-open")
    for done in (live, mixed):
        discard(done)
    # Two rows that share many entries meet in the first of them only: an entry is passed over if both rows'
    # lists of their first open entries hold an earlier one, where they meet as well (or in one before).
    early = open_.groupBy("id", "b").agg(F.slice(F.array_sort(F.collect_set("sig")), 1, EARLY).alias("early"))
    mixed = publish(open_.join(early, ["id", "b"]).join(masks, "id"), "jaccard-open")
    discard(open_)
    across = (mixed.filter("comp <> top").alias("x").join(mixed.alias("y"), F.expr(
        "x.b = y.b AND x.sig = y.sig AND x.comp <> y.comp AND (y.comp = y.top OR x.id < y.id) AND "
        f"{bounds} AND "
        "coalesce(array_min(array_intersect(x.early, y.early)), x.sig) >= x.sig"))
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct())
    across = publish(across, "jaccard-across")
    discard(mixed)
    across = publish(_sketched(across, sketches, percent), "jaccard-across")
    discard(sketches)
    more = _verified(across, docs, words, percent)
    comps = _merged(more if met is None else more.unionByName(met), label)

    found = (rows.join(label.withColumnRenamed("node", "rep"), "rep", "left")
             .select("doc_id", "n", F.coalesce("component", "rep").alias("near")))
    return (found.join(comps.select(F.col("node").alias("near"), F.col("component").alias("merged")), "near", "left")
            .select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("merged", "near").alias("component_id")))


def _with_null_ids(docs: DataFrame, words: int, percent: int, frequent: int) -> DataFrame:
    """``near_duplicates`` of a table with null doc_ids: those rows are written
    once with numbers that no doc_id has, and lose them at the end."""
    known, seed = docs.filter("doc_id IS NOT NULL"), 0
    while True:
        number = F.xxhash64(F.lit("no doc_id"), F.lit(seed), F.monotonically_increasing_id())
        numbered = publish(docs.filter("doc_id IS NULL").select(number.alias("doc_id"), "text"), "jaccard-nulls")
        own = numbered.select("doc_id")
        taken = filter_by_keys(known.select("doc_id"), own, ["doc_id"], "left_semi")
        if not taken.limit(1).count() and not own.groupBy("doc_id").count().filter("count > 1").limit(1).count():
            break
        seed += 1
    found = publish(near_duplicates(known.unionByName(numbered), words, percent, frequent), "jaccard-numbered")
    named = filter_by_keys(found, own, ["doc_id"], "left_anti")
    least = named.filter("component_id IS NOT NULL").groupBy("component_id").agg(F.min("doc_id").alias("least"))
    rows = named.select("*", F.col("doc_id").alias("id")).unionByName(
        filter_by_keys(found, own, ["doc_id"], "left_semi").select("*", F.lit(None).cast("bigint").alias("id")))
    return rows.join(least, "component_id", "left").select(F.col("id").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the
    smallest doc_id (null last), of these the one with the smallest text.

    Rows are told apart by a number written with them, not by doc_id: null and
    repeated doc_ids are rows of their own.  Rows that link with nothing stay,
    null and empty texts too.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = publish(docs.select(whole.alias("doc"), F.monotonically_increasing_id().alias("row")), "jaccard-rows", "zstd")
    found = near_duplicates(rows.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")), words, percent)
    found = publish(found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("comp")), "jaccard-found")
    groups = publish(found.groupBy("comp").agg(F.count("*").alias("c")).filter("c > 1").select("comp"), "jaccard-groups")
    members = filter_by_keys(found, groups, ["comp"], "left_semi")
    members = publish(members.join(rows.select("row", F.struct(F.col("doc.doc_id").isNull().alias("no"), "doc.doc_id").alias("id")), "row"), "jaccard-members")
    # Rows with their group's smallest doc_id; texts are compared only where there are several.
    least = publish(members.groupBy("comp").agg(F.min("id").alias("least")), "jaccard-least")
    tied = publish(members.join(least, "comp").filter("id <=> least").select("comp", "row"), "jaccard-tied")
    firsts = publish(tied.groupBy("comp").agg(F.min("row").alias("first"), F.count("*").alias("c")), "jaccard-firsts")
    texts = filter_by_keys(tied, firsts.filter("c > 1").select("comp"), ["comp"], "left_semi").join(rows.select("row", "doc.text"), "row")
    stay = publish(firsts.filter("c = 1").select(F.col("first").alias("row")).unionAll(
        texts.groupBy("comp").agg(F.min(F.struct("text", "row")).alias("best")).select("best.row")), "jaccard-stay")
    gone = publish(filter_by_keys(members.select("row"), stay, ["row"], "left_anti"), "jaccard-gone")
    return filter_by_keys(rows, gone, ["row"], "left_anti").select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))
