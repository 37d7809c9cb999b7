"""N-gram Jaccard join with token-combination prefixes (operator 2).

The tokens of a document are its word shingles. Sets are kept once: documents
with equal sets form a class, represented by its smallest id.

1. The classes' shingles are counted over the whole corpus (`chunks`), which
   gives each set one order: rare shingles first. A shingle of one class only
   can't be shared, so a set that begins with more of those than its prefix
   holds has no partner. Few sets are left after that.
2. Prefixes. Two sets that reach the similarity share at least one shingle among
   the first n - need + 1 of each (need: the least overlap a set of n allows),
   and at least two among the first n - need + 2. Of that longer prefix the rare
   shingles are indexed alone and the frequent ones in combinations of two: if a
   pair shares a rare one, it meets there; if not, both shared ones are frequent
   and it meets in their combination. Large sets, of which combinations would be
   too many, index single shingles of the shorter prefix; sets near that limit do
   both, so that pairs across it meet as well.
3. Candidates that meet are verified with their whole sets, and links become
   components. A group of documents that meet in an entry is not paired in
   full. All are compared with one member, the pivot, which has the fewest
   shingles of its own; most end in its component, and pairs of those are
   settled. A pair with a member outside it can only link if the two differ from
   the pivot in the same places, so such members meet again by what they have in
   common there (see `difference_entries`). There too all are compared with one member, and
   then with another, while that joins components. Only if several components are
   left that share a difference, pairs between them (never within one) are verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratestar.llm import chunks
from ratestar.llm.components import components
from ratestar.llm.memory import tidy_batches, tidy_cogroup, tidy_group
from ratestar.llm.package import ship
from ratestar.llm.words import BLANK_SEPARATED, Words, mix, run_hashes, slices, split_words
from ratestar.session import collect_garbage, cut_lineage

SHINGLE = 4
PERCENT = 85
#: Shingles of more classes than this are frequent and indexed in combinations.
FREQUENT = 16
#: Members with which a group is compared at most, besides its pivot, before pairs of those that linked with none are looked up.
TURNS = 8
#: Keys over which the documents of one class are spread when it is looked up.
SALTS = 16
#: Sets of more shingles index single ones only.
COMBINED_SHINGLES = 512

_U = np.uint64

_CLASS = "id long, chunk long, n_shingles long, s1 long, s2 long"
_MESSAGE = "bucket long, chunk long, hashes binary, counts binary"
_ANSWER = "bucket long, chunk long, counts binary"
_ENTRY = "id long, n long, hashes binary, entries array<long>"


def shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct shingles of each text; shorter texts with words are one shingle."""
    words: Words = split_words(column, BLANK_SEPARATED, lower=True)
    hashes, counts = words.hashes(), words.counts
    runs = run_hashes(hashes, width)
    n = len(runs)
    whole = np.arange(n) + width <= words.last()[:n]
    text, runs = words.text_of()[:n][whole], runs[whole]
    for length in range(1, width):
        short = np.flatnonzero(counts == length)
        if len(short):
            text = np.concatenate([text, short])
            runs = np.concatenate([runs, mix(run_hashes(hashes, length)[words.first[short]] + _U(length))])
    order = np.argsort(runs, kind="stable")
    a, b = runs[order], text[order]
    keep = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.empty(0, bool)
    # Equal hashes of one text needn't be neighbours when short texts came last, but those have one shingle only.
    kept = order[keep]
    kept = kept[np.argsort(text[kept], kind="stable")]
    return text[kept], runs[kept]


def _sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])
    return total[borders[1:]] - total[borders[:-1]]


def _signatures(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: set size and two hashes of the set; and the shingles they are made of."""
    text, hashes = shingles(column, width)
    borders = np.searchsorted(text, np.arange(len(column) + 1))
    first = _sums(mix(hashes), borders).view(np.int64)
    second = _sums(mix(hashes ^ _U(0xA0761D6478BD642F)), borders).view(np.int64)
    return np.diff(borders), first, second, text, hashes


def _represented(table: pa.Table, wanted: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk the ids of representatives, and (number of the representative, hash) of their shingles."""
    sizes, s1, s2, text, hashes = _signatures(table.column("text").combine_chunks(), width)
    ids = table.column("id").combine_chunks().fill_null(0).to_numpy()
    reps = {(r["id"], r["s1"], r["s2"]) for own in wanted.column("reps").to_pylist() if own for r in own}
    number = np.full(len(ids), -1, dtype=np.int64)
    chosen = []
    for row in np.flatnonzero(sizes > 0):
        key = (ids[row], s1[row], s2[row])
        if key in reps:
            reps.discard(key)  # a repeated row counts once
            number[row] = len(chosen)
            chosen.append(ids[row])
    mine = number[text]
    return np.array(chosen, dtype=np.int64), mine[mine >= 0], hashes[mine >= 0]


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct sorted hashes, how often each occurs, and the place of every hash among them."""
    order = np.argsort(hashes, kind="stable")
    edges = chunks.group_starts(hashes[order])
    counts = np.diff(np.append(edges, len(hashes))).astype(np.int64)
    place = np.empty(len(hashes), dtype=np.int64)
    place[order] = np.repeat(np.arange(len(edges)), counts)
    return hashes[order][edges], counts, place


def _send(table: pa.Table, wanted: pa.Table, width: int, buckets: int) -> pa.Table:
    rows = []
    if len(table) and len(wanted):
        distinct, counts, _ = _distinct(_represented(table, wanted, width)[2])
        rows = [(bucket, chunks.pack_sorted(distinct[a:b]), chunks.pack(counts[a:b]))
                for bucket, a, b in chunks.bucket_ranges(distinct, buckets)]
    chunk = table.column("chunk")[0].as_py() if len(table) else 0
    return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()), "chunk": pa.array([chunk] * len(rows), pa.int64()),
                     "hashes": chunks.binary([r[1] for r in rows]), "counts": chunks.binary([r[2] for r in rows])})


def _count(table: pa.Table) -> pa.Table:
    """For each message the number of classes that have each hash."""
    hashes = [chunks.unpack_sorted(x.as_py()) for x in table.column("hashes")]
    counts = np.concatenate([chunks.unpack(x.as_py()).astype(np.int64) for x in table.column("counts")])
    borders = np.cumsum([len(x) for x in hashes])[:-1]
    hashes = np.concatenate(hashes)
    order = np.argsort(hashes, kind="stable")
    edges = chunks.group_starts(hashes[order])
    total = np.empty(len(hashes), dtype=np.int64)
    total[order] = np.repeat(np.add.reduceat(counts[order], edges), np.diff(np.append(edges, len(hashes))))
    return pa.table({"bucket": table.column("bucket"), "chunk": table.column("chunk"),
                     "counts": chunks.binary([chunks.pack(x) for x in np.split(total, borders)])})


def prefix_entries(hashes: np.ndarray, counts: np.ndarray, n: int, unshared: int, percent: int,
                   frequent: int, combined: int) -> np.ndarray:
    """Index entries of a set: hashes of shared shingles in order of (count, hash), behind `unshared` others."""
    short = n - (percent * n + 99) // 100 + 1
    parts = []
    if n <= combined * 100 / percent:
        prefix = slice(0, max(0, short + 1 - unshared))
        own, often = hashes[prefix], counts[prefix] > frequent
        parts.append(own[~often])
        left, right = np.triu_indices(int(often.sum()), 1)
        common = own[often]
        parts.append(mix(mix(common[left] + _U(1)) ^ common[right]))
    if n * 100 > combined * percent:
        parts.append(hashes[:max(0, short - unshared)])
    return np.unique(np.concatenate(parts))


def _index(table: pa.Table, notes: pa.Table, width: int, buckets: int, percent: int, frequent: int, combined: int) -> pa.Table:
    out = {"id": [], "n": [], "hashes": [], "entries": []}
    if len(table) and len(notes):
        ids, number, hashes = _represented(table, notes, width)
        distinct, _, place = _distinct(hashes)
        answers = notes.filter(notes.column("bucket").is_valid())
        counts = chunks.answers_of(answers, distinct, buckets, "counts", lambda data, _: chunks.unpack(data).astype(np.int64))
        count = counts[place] if len(place) else np.empty(0, np.int64)
        borders = np.searchsorted(number, np.arange(len(ids) + 1))
        for i, (a, b) in enumerate(zip(borders[:-1], borders[1:])):
            shared = count[a:b] > 1
            n, unshared = b - a, int(b - a - shared.sum())
            if unshared > n - (percent * n + 99) // 100 + 1:
                continue  # even the longer prefix holds nothing that another set has
            own, often = hashes[a:b][shared], count[a:b][shared]
            order = np.lexsort((own, often))
            entries = prefix_entries(own[order], often[order], n, unshared, percent, frequent, combined)
            if len(entries):
                for name, value in (("id", ids[i]), ("n", n), ("hashes", np.sort(own).tobytes()), ("entries", entries.view(np.int64))):
                    out[name].append(value)
    return pa.table({"id": pa.array(out["id"], pa.int64()), "n": pa.array(out["n"], pa.int64()),
                     "hashes": chunks.binary(out["hashes"]), "entries": pa.array(out["entries"], pa.list_(pa.int64()))})


def difference_entries(
    own: np.ndarray, unshared: int, pivot: np.ndarray, pivot_unshared: int, percent: int,
) -> tuple[bool, int, np.ndarray, np.ndarray]:
    """What a set's difference from its group's pivot says about its partners.

    `own` and `pivot` are the sorted hashes of the shared shingles of both, next
    to which they have so many unshared ones; the pivot has the fewest of its group.
    Returns whether the two link, the size d of the difference, and the entries
    of it by which the set is found, as any member and as a member that is not
    linked to the pivot.

    With P the pivot's shared shingles, d(x) = |x ^ P| and D(x, y) the largest
    difference that two linked sets can have, |x ^ y| = d(x) + d(y) - 2c, where c
    counts what their differences from P have in common. A link thus needs
    c >= (d(x) + d(y) - D(x, y)) / 2. If x doesn't link to the pivot its d is so
    large that c is at least 1: such a pair shares an element of both
    differences. It is enough to index the first d - c + 1 elements in one order
    (unshared shingles, which meet nobody, then the others).
    """
    n, m = len(own) + unshared, len(pivot) + pivot_unshared
    added, missing = np.setdiff1d(own, pivot, assume_unique=True), np.setdiff1d(pivot, own, assume_unique=True)
    common = len(own) - len(added)
    linked = common * 100 >= (n + m - common) * percent
    d = unshared + len(added) + len(missing)
    order = np.concatenate([added, missing])
    slack = 100 - percent
    bound = -((m - n) * slack // (100 + percent))  # D(s, x) exceeds D(s, pivot) by no more
    as_member = max(1, -((bound + pivot_unshared - d - 1) // 2))
    largest = slack * (n + n * 100 // percent) // (100 + percent)
    as_other = max(1, d - largest)
    member = order[:max(0, d - as_member + 1 - unshared)]
    other = np.empty(0, _U) if linked else order[:max(0, d - as_other + 1 - unshared)]
    return linked, d, member, other


def _differences(batches, percent: int):
    for batch in batches:
        rows = [difference_entries(np.frombuffer(y.as_py(), _U), uy.as_py(), np.frombuffer(x.as_py(), _U), ux.as_py(), percent)
                for x, ux, y, uy in zip(batch.column("x"), batch.column("ua"), batch.column("y"), batch.column("ub"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), batch.column("nb"), batch.column("ub"), pa.array([bool(r[0]) for r in rows], pa.bool_()),
             pa.array([r[1] for r in rows], pa.int64()), *(pa.array([r[i].view(np.int64) for r in rows], pa.list_(pa.int64())) for i in (2, 3))],
            names=["pivot", "id", "n", "unshared", "linked", "d", "member", "other"])


def _overlaps(batches):
    """Adds the number of common shingles of two sets of sorted hashes."""
    for batch in batches:
        common = [len(np.intersect1d(np.frombuffer(x.as_py(), _U), np.frombuffer(y.as_py(), _U), assume_unique=True))
                  for x, y in zip(batch.column("x"), batch.column("y"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), batch.column("na"), batch.column("nb"), pa.array(common, pa.int64())],
            names=["a", "b", "na", "nb", "common"])


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    unshared = (F.col("n") - F.octet_length("hashes") / 8).cast("long")
    return (pairs.join(sets.select(F.col("id").alias("a"), F.col("n").alias("na"), unshared.alias("ua"), F.col("hashes").alias("x")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), unshared.alias("ub"), F.col("hashes").alias("y")), "b"))


def _same_id(members: DataFrame, shared: DataFrame) -> DataFrame | None:
    """(a, b): an id with different sets, and the class of each of them; None without such ids.

    An id that is a class's name has a row in that class, so it stands for all its rows.
    """
    known = members.where("id IS NOT NULL")
    kind = F.struct("s1", "s2", "n_shingles")
    several = cut_lineage(known.groupBy("id").agg(F.min(kind).alias("least"), F.max(kind).alias("most")).where("least <> most").select("id"))
    if several.isEmpty():
        return None
    sets = (known.join(several, "id", "left_semi").where("n_shingles > 0").select("id", "s1", "s2", "n_shingles").distinct()
            .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")))
    return cut_lineage(sets.join(shared, ["s1", "s2", "n_shingles", "salt"]).where("id <> class_id")
                       .select(F.col("id").alias("a"), F.col("class_id").alias("b")))


def _linked(entries: DataFrame, sets: DataFrame, percent: int, same: DataFrame | None = None) -> DataFrame:
    """(id, comp) of all linked sets. entries: (entry, id, unshared); same: links (a, b) besides those of the sets."""
    pivots = (entries.groupBy("entry").agg(F.min(F.struct("unshared", "id")).alias("pivot"), F.count("*").alias("size"))
              .where("size > 1").select("entry", F.col("pivot.id").alias("a")))
    # Entries that meet nobody go; of the others each member is compared with the pivot, once for all its entries.
    pairs = entries.join(pivots, "entry").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    compared = cut_lineage(
        _with_sets(pairs, sets).select("a", "ua", "x", "b", "nb", "ub", "y")
        .mapInArrow(tidy_batches(lambda batches: _differences(batches, percent)),
                    "pivot long, id long, n long, unshared long, linked boolean, d long, member array<long>, other array<long>"))
    links = compared.where("linked").select(F.col("pivot").alias("a"), F.col("id").alias("b"))
    if same is not None:
        links = links.unionAll(same)
    comps = cut_lineage(components(links))
    # Members outside their pivot's component, against all members: those pairs that their differences don't rule out.
    labelled = _labelled(compared, comps)
    if labelled.where("outside AND size(other) > 0").isEmpty():
        return comps
    groups = None
    for turn in range(TURNS):
        rows = _difference_rows(labelled)
        # Where several components meet, all are compared with one more member, another one each turn.
        groups = rows.groupBy("pivot", "element").agg(
            F.min("comp").alias("least"), F.max("comp").alias("most"),
            F.min(F.when(F.col("other"), F.struct(F.xxhash64("id", F.lit(turn)).alias("order"), "id", "comp"))).alias("center")).where(
            "least <> most AND center IS NOT NULL").select("pivot", "element", F.col("center.id").alias("center"), F.col("center.comp").alias("center_comp"))
        groups = cut_lineage(groups)
        near = rows.join(groups, ["pivot", "element"]).where("comp <> center_comp").select(F.least("center", "id").alias("a"), F.greatest("center", "id").alias("b"))
        new = _verified(near.distinct(), sets, percent)
        if new.isEmpty():
            break
        links = cut_lineage(links.unionAll(new))
        comps = cut_lineage(components(links))
        labelled = _labelled(compared, comps)
        collect_garbage(links.sparkSession)
    # What is left differs from its centers too: pairs of different components that share an element.
    rows = _difference_rows(labelled).join(groups.select("pivot", "element"), ["pivot", "element"], "left_semi")

    def side(rows: DataFrame, end: str) -> DataFrame:
        return rows.select("pivot", "element", *[F.col(c).alias(c + end) for c in ("id", "n", "unshared", "d", "comp")])

    largest = F.floor((F.col("n1") + F.col("n2")) * (100 - percent) / (100 + percent))
    found = side(rows.where("other"), "1").join(side(rows.where("NOT other"), "2"), ["pivot", "element"]).where(
        (F.col("comp1") != F.col("comp2")) & (F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent)
        & (F.col("d1") + F.col("d2") - largest <= 2 * F.least(F.col("d1") - F.col("unshared1"), F.col("d2") - F.col("unshared2"))))
    verified = _verified(found.select(F.least("id1", "id2").alias("a"), F.greatest("id1", "id2").alias("b")).distinct(), sets, percent)
    if verified.isEmpty():
        return comps
    return components(links.unionAll(verified))


def _labelled(compared: DataFrame, comps: DataFrame) -> DataFrame:
    """All sets that were compared with a pivot that has others, and their components.

    Others are `outside`: not linked to their pivot, and not in its component either. Written, as
    each turn reads it several times.
    """
    labelled = (compared.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
                .join(comps.select(F.col("id").alias("pivot"), F.col("comp").alias("pivot_comp")), "pivot", "left")
                .withColumn("outside", (F.col("comp") != F.coalesce("pivot_comp", "pivot")) & ~F.col("linked")))
    return cut_lineage(labelled.join(labelled.where("outside").select("pivot").distinct(), "pivot", "left_semi"))


def _difference_rows(labelled: DataFrame) -> DataFrame:
    """A row for each element by which a set's difference from its pivot is looked up, as any member or as an `other` one."""
    def rows(some: DataFrame, column: str, other: bool) -> DataFrame:
        return some.select("pivot", F.explode(column).alias("element"), "id", "n", "unshared", "d", "comp", F.lit(other).alias("other"))

    return rows(labelled.where("outside"), "other", True).unionAll(rows(labelled, "member", False))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that reach the similarity."""
    return cut_lineage(
        _with_sets(pairs, sets).select("a", "b", "na", "nb", "x", "y").mapInArrow(tidy_batches(_overlaps), "a long, b long, na long, nb long, common long")
        .where(F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * percent).select("a", "b"))


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT,
    frequent: int = FREQUENT, combined: int = COMBINED_SHINGLES, chunk_bytes: int | None = None,
    bucket_bytes: int | None = None,
) -> DataFrame:
    """One row per document with its set size, class and component under Jaccard links of word shingles.

    Words are runs of characters other than ASCII white space, with A-Z
    lower-cased. A set holds the distinct shingles of `width` words of a whole
    text; a text with fewer words, but not none, is one shingle. Sets link when
    100 * intersection >= percent * union (at least 51). Returns the id,
    n_shingles, class_id (smallest id with an equal set) and component_id
    (smallest id that links reach).

    Texts without words, null ones too, link with nothing, not even each other.
    Rows with a null id keep null class and component and link with nothing.
    Rows that repeat an id are one node: what links with either is in their
    component. Empty tables give empty results; other columns don't matter.
    """
    if not 51 <= percent <= 100:
        raise ValueError("percent must be from 51 to 100: below, two sets may share a single shingle")
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size, count = chunks.text_bytes(rows, F.col("text"))
    fitting = chunks.fitting(size)
    chunk_bytes, bucket_bytes = chunk_bytes or fitting[0], bucket_bytes or fitting[1]
    buckets, number = chunks.bucket_count(size, bucket_bytes), chunks.chunk_count(size, count, chunk_bytes)
    chunk = F.pmod(F.xxhash64("id", "text"), F.lit(number)).alias("chunk")

    def describe(batches):
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                part = batch.slice(begin, end - begin)
                sizes, s1, s2, _, _ = _signatures(part.column("text"), width)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("chunk"), pa.array(sizes.astype(np.int64)), pa.array(s1), pa.array(s2)],
                    names=["id", "chunk", "n_shingles", "s1", "s2"])

    members = cut_lineage(rows.select("id", "text", chunk).mapInArrow(tidy_batches(describe), _CLASS))
    classes = (members.where("n_shingles > 0 AND id IS NOT NULL").groupBy("s1", "s2", "n_shingles")
               .agg(F.min(F.struct("id", "chunk")).alias("rep"), F.count("*").alias("size")))
    reps = classes.groupBy("rep.chunk").agg(F.collect_list(F.struct("rep.id", "s1", "s2")).alias("reps"))
    dealt = chunks.in_chunks(rows, number, "id", "text")

    def send(table: pa.Table, wanted: pa.Table) -> pa.Table:
        return _send(table, wanted, width, buckets)

    def index(table: pa.Table, notes: pa.Table) -> pa.Table:
        return _index(table, notes, width, buckets, percent, frequent, combined)

    answers = (dealt.groupBy("chunk").cogroup(reps.groupBy("chunk")).applyInArrow(tidy_cogroup(send), _MESSAGE)
               .groupBy("bucket").applyInArrow(tidy_group(_count), _ANSWER))
    notes = answers.unionByName(reps, allowMissingColumns=True)
    sets = cut_lineage(dealt.groupBy("chunk").cogroup(notes.groupBy("chunk")).applyInArrow(tidy_cogroup(index), _ENTRY))
    unshared = (F.col("n") - F.octet_length("hashes") / 8).cast("long").alias("unshared")
    # Only classes of several documents are looked up, and a large one under several keys.
    shared = (classes.where("size > 1").select("s1", "s2", "n_shingles", F.col("rep.id").alias("class_id"))
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    linked = _linked(sets.select(F.explode("entries").alias("entry"), "id", unshared), sets.select("id", "n", "hashes"), percent,
                     _same_id(members, shared))
    keyed = (members.withColumn("salt", F.pmod(F.xxhash64("id", "chunk"), F.lit(SALTS)).cast("int"))
             .join(shared, ["s1", "s2", "n_shingles", "salt"], "left"))
    own = F.when(F.col("n_shingles") > 0, F.coalesce("class_id", "id")).otherwise(F.col("id"))
    return (keyed.withColumn("class_id", F.when(F.col("id").isNotNull(), own))
            .join(linked.select(F.col("id").alias("class_id"), "comp"), "class_id", "left")
            .select(F.col("id").alias(id_col), "n_shingles", "class_id", F.coalesce("comp", "class_id").alias("component_id")))


def op2_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    found = jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_shingles", "component_id")


OP2_SQL = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
tokens AS (
    SELECT DISTINCT doc_id, array_to_string(w[p:p + least(4, len(w)) - 1], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 0) + 2)) AS p FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM tokens x JOIN tokens y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b
    WHERE 100 * k >= 85 * (sa.n + sb.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT docs.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM docs LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""
