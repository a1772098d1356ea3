"""Near-duplicate classes by ProbMinHash signatures, banding and exact verification.

A text is a weighted set: its five-word shingles, each with weight 1 + log10(count), so that a line
repeated hundreds of times does not stand for the whole text.  Every shingle runs a Poisson process
whose arrivals fall into ``slots``; a text's signature keeps, per slot, the shingle of the earliest
arrival, where a shingle of weight w arrives w times as fast.  Two signatures agree in a
slot with the probability Jaccard similarity of the texts.  A shingle stops as soon as its next
arrival comes after the latest of the text's slots (early termination).

1. One pass over the texts writes id, content digest and band keys; no text is shuffled for it.
   Copies (equal word sequences) share a digest; a representative is a numbered digest.
2. Band keys of at least two representatives are buckets.  No bucket is gathered or paired with
   itself: each member meets the bucket's most central member (the one whose buckets are largest)
   and that of its sub-bucket (the members that share the next band too).  Both are combined
   maxima, so a bucket with a third of all rows costs a row per member.
3. Pairs are verified on whole texts: exact probability Jaccard of the weighted shingles.
4. Components of the verified links are classes.  A bucket that holds several is *open*.  Members of
   open buckets get a second, independent signature, of which several keys of several lengths cut them
   into finer sub-buckets.  Each member meets the centre of each of its sub-buckets, drawn by a hash, if
   it is of another class, and the pairs are verified like all others.  A bucket whose members were
   linked and that is still open goes on with new keys, for ``finer_rounds`` rounds at most; one without
   a new link stops.  A round costs each open member a row per key, whatever the size of the bucket.
5. All members of buckets that are still open are joined by their rarest shingles: any two of different
   classes that may reach the similarity are verified.  So similar texts of one bucket always end in
   one class.  The candidates grow with the square of a group of texts that lie just below the
   similarity; ``exact=False`` leaves this step, and with it links, out.

Nulls and empty texts have no words: they are copies of each other and near to nothing else.  A
text of fewer than five words has one shingle of all its words.  Rows with a null id are passed
through with a null class.  Repeated rows of one id are one document; an id with several different
texts is a document for each, and a class's representative is its smallest id, of one id the text of
the smallest digest.  Empty tables give no rows.
Other columns are ignored, so their names cannot clash.
"""

import hashlib
import random
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ledgerwatch.llm import words
from ledgerwatch.llm.batches import map_texts
from ledgerwatch.llm.components import components
from ledgerwatch.llm.staging import stage


@dataclass(frozen=True)
class NearConfig:
    shingle_words: int = 5
    similarity: float = 0.8
    slots: int = 128  # a power of two up to 2048
    bands: int = 25
    rows: int = 5
    finer_rows: tuple = (6, 9, 12)  # slots of the second signature in a key of a sub-bucket
    finer_keys: int = 4  # keys of each length, in each round
    finer_rounds: int = 2
    exact: bool = True  # join the open buckets exactly
    parity_words: int = 16  # 64-bit words of a text's parities, by which the exact join drops pairs


def _lowered(texts):
    return [t.lower() if isinstance(t, str) else None for t in texts]


def weighted(raws, n):
    """Distinct shingles: (hashes sorted per text, weights, offsets per text, word hashes, offsets)."""
    hashes, word_at = words.word_hashes(raws)
    grams, at = words.ngrams(hashes, word_at, n)
    owner = np.repeat(np.arange(len(raws)), np.diff(at))
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(fresh)
    counts = np.diff(np.append(first, len(grams)))
    return (grams[first], 1.0 + np.log10(counts), np.searchsorted(owner[first], np.arange(len(raws) + 1)),
            hashes, word_at)


def signatures(grams, weights, at, slots):
    """ProbMinHash signatures (texts x slots) of weighted shingles; all zero for an empty text."""
    texts = len(at) - 1
    held = np.diff(at)
    element, text = grams, np.repeat(np.arange(texts), held)
    rate, when = weights, np.zeros(len(grams))
    arrivals = np.zeros(len(grams), np.uint64)
    # Few shingles need many arrivals each: draw about two per slot and text at a time.
    ahead = 2 ** np.ceil(np.log2(np.clip(2 * slots / np.maximum(held, 1), 1, 2 * slots)))
    ahead = ahead.astype(np.int64)[text] if len(text) else np.zeros(0, np.int64)
    earliest = np.full(texts * slots, np.inf)
    winner = np.zeros(texts * slots, np.uint64)
    while len(element):
        for step in np.unique(ahead):
            of = np.flatnonzero(ahead == step)
            number = arrivals[of][:, None] + np.arange(1, step + 1, dtype=np.uint64)
            bits = words.mix64(element[of][:, None] ^ words.mix64(number))
            gap = -np.log(((bits >> np.uint64(11)) + np.uint64(1)) * 2.0 ** -53)
            moment = when[of][:, None] + np.cumsum(gap / rate[of][:, None], axis=1)
            place = text[of][:, None] * slots + (bits & np.uint64(slots - 1)).astype(np.int64)
            place, flat = place.ravel(), moment.ravel()
            np.minimum.at(earliest, place, flat)
            won = flat == earliest[place]
            winner[place[won]] = np.repeat(element[of], step)[won]
            when[of] = moment[:, -1]
            arrivals[of] += np.uint64(step)
        latest = earliest.reshape(texts, slots).max(axis=1)
        on = when < latest[text]
        element, text, rate, when = element[on], text[on], rate[on], when[on]
        arrivals, ahead = arrivals[on], ahead[on]
    return winner.reshape(texts, slots)


def band_keys(signature, bands, rows):
    """One 64-bit key per band; bands never share a key space."""
    out = np.zeros((len(signature), bands), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            key = np.full(len(signature), b + 1, np.uint64)
            for r in range(rows):
                key = words.mix64(key * np.uint64(0x100000001B3) ^ signature[:, b * rows + r])
            out[:, b] = key
    return out.view(np.int64)


def _digest(hashes):
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


@F.pandas_udf(BinaryType())
def digest_of(text: pd.Series) -> pd.Series:
    """The content digest alone."""
    out = []
    for _, raws in words.slices(_lowered(text)):
        hashes, at = words.word_hashes(raws)
        out += [_digest(hashes[i:j]) for i, j in zip(at, at[1:])]
    return pd.Series(out, dtype=object)


def sketch(docs, config, id_col, text_col):
    """(id, digest, bands) per row; one pass, no shuffle."""

    def run(batches):
        for b in batches:
            digests, keys = [], []
            for _, raws in words.slices(_lowered(b["text"])):
                grams, weights, at, hashes, word_at = weighted(raws, config.shingle_words)
                digests += [_digest(hashes[i:j]) for i, j in zip(word_at[:-1], word_at[1:])]
                rows = band_keys(signatures(grams, weights, at, config.slots), config.bands,
                                 config.rows)
                keys += [r if n else r[:0] for r, n in zip(rows, np.diff(at))]
            yield pd.DataFrame({"id": b["id"], "digest": digests, "bands": keys})

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return plain.mapInPandas(run, f"id {plain.schema['id'].dataType.simpleString()}, "
                                  "digest binary, bands array<long>")


def probability_jaccard(a, x, b, y):
    """Exact J_P of two weighted sets (sorted distinct hashes and their weights)."""
    if not len(a) or not len(b):
        return 0.0
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = b[place] == a
    xs, ys = x[both], y[place[both]]
    if not len(xs):
        return 0.0
    order = np.argsort(xs / ys, kind="stable")
    xs, ys = xs[order], ys[order]
    ratio = xs / ys
    low = np.searchsorted(ratio, ratio, side="left")
    x_upto = np.concatenate([[0.0], np.cumsum(xs)])
    y_upto = np.concatenate([[0.0], np.cumsum(ys)])
    x_from = x.sum() - x_upto[low]
    y_before = y.sum() - ys.sum() + y_upto[low]
    return float(np.sum(1.0 / (x_from / xs + y_before / ys)))


def verify(pairs, texts, config):
    """(a, b, similarity) of the pairs whose whole texts reach the similarity.

    Pairs are compared in slices of bounded bytes (or one longer pair).  Texts come to the pairs of one
    ``b`` side by side, so a centre's weighted set is mostly made once a slice.
    """

    def run(batches):
        for batch in batches:
            a, b, left, right = batch.columns
            both = ((x.as_py(), y.as_py()) for x, y in zip(left, right))
            at, part, size = 0, [], 0
            for pair in both:
                if part and size + sum(map(len, pair)) > words.SLICE_BYTES:
                    yield compared(batch.slice(at, len(part)), part)
                    at, part, size = at + len(part), [], 0
                part.append(pair)
                size += sum(map(len, pair))
            if part:
                yield compared(batch.slice(at, len(part)), part)

    def compared(rows, part):
        known = {}
        for pair in part:
            for text in pair:
                known.setdefault(text, len(known))
        vectors = []
        for _, raws in words.slices(_lowered(known)):
            grams, weights, at, *_ = weighted(raws, config.shingle_words)
            vectors += [(grams[i:j], weights[i:j]) for i, j in zip(at, at[1:])]
        found = np.array([probability_jaccard(*vectors[known[x]], *vectors[known[y]]) for x, y in part])
        out = pa.RecordBatch.from_arrays([*rows.columns[:2], pa.array(found, pa.float64())],
                                         ["a", "b", "similarity"])
        return out.filter(pa.array(found >= config.similarity))

    kind = pairs.schema["a"].dataType.simpleString()
    full = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b"))
    return full.select("a", "b", "ta", "tb").mapInArrow(run, f"a {kind}, b {kind}, "
                                                             "similarity double")


def _star(entries, key):
    """(a, b) of every member and the most central member of its group."""
    centre = entries.groupBy(key).agg(F.max(F.struct("rank", "node")).alias("c"))
    pairs = entries.select(key, "node").join(
        centre.select(key, F.col("c.node").alias("centre")), key)
    return pairs.filter("node <> centre").select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))


def _open(entries, label):
    """(key, node, class) of all members of the buckets that hold more than one class."""
    placed = stage(entries.join(label, entries.node == label.n, "left").select(
        "key", "node", F.coalesce("component", "node").alias("class")), "placed-entries")
    several = placed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    return stage(placed.join(several.filter("low <> high").select("key"), "key"), "open")


def _marks(texts, nodes, config):
    """(node, marks): the slots of a second signature, as 32-bit numbers."""

    def make(_, raws):
        grams, weights, at, *_ = weighted(raws, config.shingle_words)
        second = signatures(words.mix64(grams ^ np.uint64(0x9D8F)), weights, at, config.slots)
        return {"marks": pa.array(list(second.astype(np.uint32).view(np.int32)), pa.list_(pa.int32()))}

    own = texts.join(nodes.select(F.col("node").alias("id")), "id", "left_semi")
    return map_texts(own, make, "marks array<int>", "id").withColumnRenamed("id", "node")


def _finer_pairs(nodes, marks, turn, config):
    """(a, b) of members of open buckets (node, class) and the centres of their sub-buckets."""
    draw = random.Random(turn)
    places = [draw.sample(range(config.slots), rows) for rows in config.finer_rows
              for _ in range(config.finer_keys)]
    keys = [F.xxhash64(F.lit(j), *[F.get("marks", F.lit(p)) for p in of]) for j, of in enumerate(places)]
    groups = stage(nodes.join(marks, "node").select(
        "node", "class", F.explode(F.array(*keys)).alias("group")), "finer")
    centre = groups.groupBy("group").agg(
        F.max(F.struct(F.xxhash64("group", "node").alias("r"), "node", "class")).alias("c"))
    return groups.join(centre, "group").filter("class <> c.class").select(
        F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b"))


def _parities(grams, config):
    """(node, held, weight, parity): number of shingles, their weight, and parities of their numbers by bin."""
    place = F.pmod(F.xxhash64("gram"), F.lit(64 * config.parity_words)).cast("int")
    bit = F.expr("shiftleft(1L, _place % 64)")
    rows = grams.withColumn("_place", place).withColumn("_word", F.floor(F.col("_place") / 64)).withColumn("_bit", bit)
    return rows.groupBy("node").agg(
        F.count("*").alias("held"), F.max("total").alias("weight"),
        F.array(*[F.bit_xor(F.when(F.col("_word") == i, F.col("_bit")).otherwise(F.lit(0).cast("long")))
                  for i in range(config.parity_words)]).alias("parity"))


def prefix_pairs(nodes, texts, config):
    """(a, b) of ``nodes`` (node, class): every pair of two classes that can reach the similarity.

    J_P is the collision of a coupling, so it is at most the overlap of the weights divided by their
    sums, the sum of minima.  It is also at most 1 / (1/p + 1/q - 1), p and q being the parts of the two
    texts' weights that lie on shingles of both: a shared shingle's term is concave in the ratio of its
    two weights, so equal ratios give the most.  Shingles are ordered by their number of texts, rarest
    first; what a text holds from the first shared one on bounds its part.  A text's prefix is its
    shortest beginning after which less than ``similarity`` is left: two texts whose prefixes share
    nothing share less.  Shingles of one text alone match nothing, so a text with enough of them has no
    prefix.  Prefixes meet only at shingles from which on both texts hold enough together.  A text's
    shingles fall into bins, of which it keeps the parities of their numbers: bins of two texts that differ
    hold a shingle of one text alone, of weight 1 at least (a bitmap filter).  What the prefixes share,
    and the rests after it, bound a pair once more.  The classes of a shingle meet across, not within the
    largest one, and a shingle of many texts is dealt over salts.  Comparing parities is still quadratic in
    groups just below the similarity; few of these pairs are made.
    """
    least = config.similarity - 1e-9
    kind = nodes.schema["node"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for first, raws in words.slices(_lowered(b["text"])):
                grams, weights, at, *_ = weighted(raws, config.shingle_words)
                held = np.diff(at)
                owner = np.repeat(np.arange(len(raws)), held)
                total = np.bincount(owner, weights=weights, minlength=len(raws))
                yield pd.DataFrame({"node": np.repeat(b["id"].to_numpy()[first:first + len(raws)], held),
                                    "gram": grams.view(np.int64), "mass": weights / total[owner],
                                    "total": total[owner]})

    own = texts.join(nodes.select(F.col("node").alias("id")), "id", "left_semi").select("id", "text")
    grams = stage(own.mapInPandas(run, f"node {kind}, gram long, mass double, total double"), "grams")
    df = grams.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1")
    shared = stage(grams.drop("total").join(df, "gram"), "shared-grams")
    enough = shared.groupBy("node").agg(F.sum("mass").alias("held")).filter(F.col("held") >= least)
    order = Window.partitionBy("node").orderBy(F.desc("df"), F.desc("gram"))
    # From the most common shingle on: what is left after a shingle, and with it.
    after = F.sum("mass").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    prefix = (shared.join(enough.select("node"), "node").withColumn("upto", after)
              .filter(F.col("upto") >= least)
              .join(nodes, "node").select("gram", "node", "class", "mass", "upto"))
    prefix = stage(prefix, "prefix")
    most = 1 + 1 / least  # of 1/p + 1/q
    size = prefix.groupBy("gram", "class").agg(F.count("*").alias("n"), F.max("upto").alias("top"))
    main = size.groupBy("gram").agg(
        F.max(F.struct("n", "class")).alias("m"), F.sum("n").alias("all"), F.max("top").alias("top"))
    several = stage(main.filter("all > m.n").select(
        "gram", "top", F.col("m.class").alias("main"), F.ceil(F.col("all") / 512).cast("int").alias("salts")),
        "several")
    able = prefix.join(several, "gram").filter(1 / F.col("upto") + 1 / F.col("top") <= most).drop("top")
    dealt = stage(able.join(_parities(grams, config), "node"), "dealt")
    left = dealt.filter("class <> main").select(
        "gram", F.col("node").alias("x"), F.col("class").alias("xc"), F.col("mass").alias("xm"),
        F.col("upto").alias("xu"), F.col("held").alias("xh"), F.col("weight").alias("xw"),
        F.col("parity").alias("xp"), F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"))
    right = dealt.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    differ = reduce(lambda a, b: a + b, [F.bit_count(F.get("xp", F.lit(i)).bitwiseXOR(F.get("parity", F.lit(i))))
                                         for i in range(config.parity_words)])
    # the shingles of one text alone: at least ``differ`` in all, and their difference is that of all shingles
    x_alone, alone = (differ + F.col("xh") - F.col("held")) / 2, (differ + F.col("held") - F.col("xh")) / 2
    p, q = 1 - F.greatest(x_alone, F.lit(0)) / F.col("xw"), 1 - F.greatest(alone, F.lit(0)) / F.col("weight")
    met = left.join(right, ["gram", "salt"]).filter(
        "xc <> class AND (class = main OR x < node)").filter(
        (1 / F.col("xu") + 1 / F.col("upto") <= most) & (p > 0.5) & (q > 0.5) & (p + q <= most * p * q))
    # of the shared shingles, in their order, those up to some place have met: the others lie in the rests
    x_rest, rest, ahead = F.col("xu") - F.col("xm"), F.col("upto") - F.col("mass"), F.col("x") < F.col("node")
    met = met.groupBy(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).agg(
        F.sum(F.least("xm", "mass")).alias("common"),
        F.sum(F.when(ahead, F.col("xm")).otherwise(F.col("mass"))).alias("am"),
        F.sum(F.when(ahead, F.col("mass")).otherwise(F.col("xm"))).alias("bm"),
        F.min(F.when(ahead, x_rest).otherwise(rest)).alias("ar"),
        F.min(F.when(ahead, rest).otherwise(x_rest)).alias("br"))
    return met.filter(
        (F.col("common") + F.least("ar", "br") >= least)
        & (1 / (F.col("am") + F.col("ar")) + 1 / (F.col("bm") + F.col("br")) <= most)).select("a", "b")


def links(sketches, docs, config, id_col="doc_id", text_col="text"):
    """(representatives: digest, id, copies, node; links: a, b, similarity), both stored."""
    known = sketches.filter("id IS NOT NULL")
    reps = stage(known.groupBy("digest").agg(
        F.min("id").alias("id"), F.count_distinct("id").alias("copies")).withColumn(
            "node", F.monotonically_increasing_id()), "reps")
    own = known.join(reps.select("id", "digest", "node"), ["id", "digest"])
    band = own.select("node", "bands", F.posexplode("bands").alias("i", "key"))
    band = band.select("key", "node", F.xxhash64(
        "key", F.element_at("bands", ((F.col("i") + 1) % config.bands + 1).cast("int"))).alias(
            "sub")).distinct()
    size = band.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    entries = band.join(size, "key")
    rank = entries.groupBy("node").agg(F.sum("n").alias("rank"))
    entries = stage(entries.drop("n").join(rank, "node"), "entries")
    # The text of a representative is told from others of its id by its digest.
    wanted = reps.join(entries.select("node").distinct(), "node", "left_semi").select(
        "id", "node", F.col("digest").alias("its"))
    texts = stage(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(wanted, "id")
        .withColumn("digest", digest_of("text")).filter("digest = its")
        .dropDuplicates(["id", "node"]).select(F.col("node").alias("id"), "text"), "texts")
    tested, found = [], []

    def test(pairs):
        """Verify those of ``pairs`` that were not before; returns the new links."""
        if tested:
            pairs = pairs.join(reduce(DataFrame.unionAll, tested), ["a", "b"], "left_anti")
        tested.append(stage(pairs, "pairs"))
        found.append(stage(verify(tested[-1], texts, config), "links"))
        return found[-1]

    def labelled():
        return components(reduce(DataFrame.unionAll, found), "a", "b").withColumnRenamed("node", "n")

    test(_star(entries, "key").unionAll(_star(entries, "sub")).distinct())
    live, marks = entries, None
    for turn in range(config.finer_rounds):
        live = _open(live, labelled())
        if live.isEmpty():
            break
        nodes = live.select("node", "class").distinct()
        if marks is None:
            marks = stage(_marks(texts, nodes, config), "marks")
        fresh = test(_finer_pairs(nodes, marks, turn, config).distinct())
        ends = fresh.select(F.col("a").alias("node")).unionAll(fresh.select("b")).distinct()
        moving = live.join(ends, "node", "left_semi").select("key").distinct()
        live = live.join(moving, "key", "left_semi").select("key", "node")
    if config.exact:
        open_nodes = _open(entries, labelled()).select("node", "class").distinct()
        test(prefix_pairs(stage(open_nodes, "open-nodes"), texts, config))
    return reps, reduce(DataFrame.unionAll, found)


def _classified(docs, config, id_col, text_col):
    """(sketches; digest, class_id, class_size, copies, best), stored; best: id and digest."""
    sketches = stage(sketch(docs, config, id_col, text_col), "sketches")
    reps, found = links(sketches, docs, config, id_col, text_col)
    label = components(found, "a", "b")
    placed = reps.withColumnRenamed("id", "least").join(label, "node", "left").select(
        "digest", "copies", "least", F.coalesce("component", "node").alias("class"))
    placed = stage(placed, "placed")
    sizes = stage(placed.groupBy("class").agg(
        F.sum("copies").alias("class_size"), F.min(F.struct("least", "digest")).alias("best")), "sizes")
    return sketches, stage(placed.join(sizes, "class").select(
        "digest", F.col("best.least").alias("class_id"), "class_size", "copies", "best"), "sized")


def classes(docs, config=NearConfig(), id_col="doc_id", text_col="text"):
    """(id, class_id, class_size, copies): the class of every row's document.

    ``class_id`` is the smallest id of the class, ``copies`` the number of ids with the same words,
    ``class_size`` the sum of these over the class's texts.  An id with several texts has a row for
    each; every row with a null id has its own row, with nulls.
    """
    sketches, sized = _classified(docs, config, id_col, text_col)
    rows = sketches.select("id", "digest")
    out = rows.filter("id IS NOT NULL").distinct().join(sized.drop("best"), "digest").select(
        F.col("id").alias(id_col), "class_id", "class_size", "copies")
    return out.unionAll(rows.filter("id IS NULL").select(
        F.col("id").alias(id_col), *[F.lit(None).cast(out.schema[c].dataType).alias(c)
                                     for c in out.columns[1:]]))


def keep_one(docs, config=NearConfig(), id_col="doc_id", text_col="text"):
    """The rows of ``docs`` whose document represents its class (the smallest id), unchanged.

    Rows with a null id stay.  Repeated rows of a kept document stay too.
    """
    sketches, sized = _classified(docs, config, id_col, text_col)
    known = sketches.filter("id IS NOT NULL").select("id", "digest").distinct()
    texts = known.groupBy("id").agg(F.count("*").alias("texts"))
    best = sized.select("best.*").distinct().withColumnRenamed("least", "_kept_id")
    held = best.groupBy("_kept_id").agg(F.count("*").alias("kept"))
    held = stage(held.join(texts, held["_kept_id"] == texts["id"]).select(
        "_kept_id", F.col("kept") == F.col("texts")), "kept")
    held = held.toDF("_kept_id", "all")
    out = docs.join(held.filter("all"), docs[id_col] == F.col("_kept_id"), "left_semi").unionAll(
        docs.filter(F.col(id_col).isNull()))
    some = held.filter("NOT all")
    if some.isEmpty():
        return out
    # Ids of which only some texts stay: the digest decides.
    mixed = docs.join(some, docs[id_col] == F.col("_kept_id"), "left_semi")
    best = best.withColumnRenamed("digest", "_kept_digest")
    kept = mixed.withColumn("_digest", digest_of(F.col(text_col))).join(
        best, (mixed[id_col] == F.col("_kept_id")) & (F.col("_digest") == F.col("_kept_digest")),
        "left_semi")
    return out.unionAll(kept.drop("_digest"))
