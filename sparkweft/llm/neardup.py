"""Near-duplicate detection by a signature-coordinate inverted join over MinHash signatures.

A document is the set of its word shingles. Documents with equal sets form a class; one of each class
goes on. A class has a signature of COORDINATES minima, and is posted under each (coordinate, value) pair,
a token. Two sets with similarity s agree in each coordinate with probability s, so pairs at or above
the wanted 0.8 have at least MATCHES tokens in common, but for a chance below one in 10,000 at exactly
0.8 and far less above it.

Prefix: tokens are ordered by the length of their lists, and a class is posted only under the rarest
COORDINATES - MATCHES + COLLISIONS of its tokens. Two classes with MATCHES common tokens have COLLISIONS of them
in both prefixes. Skipping: the other, longest lists are never merged; they count only when signatures
are compared. Tokens that one class alone has take up places of the prefix and are dropped.

Short lists (up to SHORT) give their pairs, of which those that collide COLLISIONS times are kept. A longer list
gives none of its pairs, but pairs each member with a few pivots, chosen alike in many lists, so a group of
many near copies costs its size times a constant. Pairs whose signatures agree in MATCHES coordinates are
confirmed on the full sets, and confirmed links give components. Pairs inside a component need no more
work. What long lists may still hide are links between members of different components. The members of such lists are posted
once more, now under shingles: two sets that are similar enough have one of their rarest shingles in common, if each is
posted under one more than it may lack of the other. Text that very many documents share is not among the rarest of
any that differ enough, so these lists are short, and their pairs across components are compared by signatures first and by full sets at last.
Only lists of sets that differ in little more than what they may lack stay long. In each of these the members outside its largest component,
the strays, are compared in blocks with the members of other components: first by signatures alone, then those that agree with some other
on their full sets at once, and one link for each stray and component is returned. So no pair is left out, whatever the length of the list; no
rows are made for pairs of long lists.

Sets hold 64-bit hashes of shingles; a class is known by a 128-bit digest of its set.

Defined results: null text, or text without words, has an empty set and is linked with nothing. Rows that
share a doc_id are one node; rows with a null doc_id take no part in links, belong to the component of
their class, and are kept if that has no other member. Repeated rows come out repeated. An empty table gives an
empty result. Other columns are left to the caller.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import passing
from .components import components
from .shared import bounded, free_prefix, own, small, written

WORDS = 5
PERCENT = 80
COORDINATES = 64
MATCHES = 36
COLLISIONS = 3
SHORT = 32
PIVOTS = 2
BLOCK = 1024
#: Buckets by which shingles are counted where long lists are taken apart.
BUCKET_BITS = 18
#: Hashes of words that a task remembers.
REMEMBERED = 300_000

_rng = np.random.default_rng(20)
_SCALE = _rng.integers(0, 1 << 32, COORDINATES, dtype=np.uint32) | np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, COORDINATES, dtype=np.uint32)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, words: int, hashes: dict[bytes, int]) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles. A to Z count as a to z; bytes.split() parts at the six blanks of the contract."""
    parts = text.encode("utf-8", "replace").lower().split() if text else []
    if not parts:
        return np.zeros(0, np.uint64)
    word = np.fromiter(map(hashes.__getitem__, parts), np.uint64, len(parts))
    n = min(words, len(parts))
    out = np.full(len(parts) - n + 1, n, np.uint64)
    for i in range(n):
        out = (out ^ word[i : len(parts) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """The least value of each coordinate's hash over a set."""
    folded = ((found * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(folded), 2048):
        value = folded[i : i + 2048, None] * _SCALE + _SHIFT
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        value ^= value >> np.uint32(12)
        least = np.minimum(least, value.min(axis=0))
    return least


def _digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _signed(words: int):
    """Rows (doc_id, n_shingles, key, signature); a task gives a key's signature once."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = _WordHashes(), set()
        for batch in batches:
            sizes, keys, signatures = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, words, hashes)
                key = _digest(found)
                sizes.append(len(found))
                keys.append(key)
                signatures.append(None if key in seen or not len(found) else signature(found).tobytes())
                seen.add(key)
            if len(seen) > 1 << 20:
                seen.clear()
            yield pa.record_batch([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())], names=["doc_id", "n_shingles", "key", "signature"])

    return go


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    coordinate = np.arange(COORDINATES, dtype=np.int64) << 32
    for batch in batches:
        for i in range(0, len(batch), 2048):
            part = batch.slice(i, 2048)
            values = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
            yield pa.record_batch([pa.array((coordinate | values).ravel()), pa.array(np.repeat(part.column("rep").to_numpy(), COORDINATES))], names=["token", "rep"])


def _sets(words: int):
    """Rows (id, found) of the texts whose set has the digest _key: rows that share an id can have several texts."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            ids, keys, texts = batch.column("doc_id"), batch.column("_key").to_pylist(), batch.column("text").to_pylist()
            for i in range(0, len(texts), 256):
                found = [shingles(t, words, hashes) for t in texts[i : i + 256]]
                own = [n for n, x in enumerate(found) if _digest(x) == keys[i + n]]
                found = [found[n] for n in own]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).astype(np.int64)))
                yield pa.record_batch([ids.take(pa.array([i + n for n in own], pa.int64())), lists], names=["id", "found"])

    return go


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, COORDINATES) for c in ("sa", "sb"))
        keep = pa.array((left == right).sum(axis=1) >= MATCHES)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column one after the other, and where each row's start; one more for the end."""
    whole = column.combine_chunks()
    return whole.flatten().to_numpy(), np.concatenate([[0], np.cumsum(whole.value_lengths().to_numpy())])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many sets of a task's rows have a shingle, by buckets of shingles."""
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in batches:
        counts += np.bincount(batch.column("found").flatten().to_numpy().view(np.uint64) >> np.uint64(64 - BUCKET_BITS), minlength=1 << BUCKET_BITS)
    at = np.flatnonzero(counts)
    yield pa.record_batch([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])


def _rarest(counts: np.ndarray, percent: int):
    """Rows (token, rep): each set's rarest shingles, as many as one more than a set may lack of another that is similar enough.

    Sets with a similarity of at least percent have one of these in common, whatever the order is, if it is one order for all: here by
    the counts of buckets, then by hash.
    """

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, reps = [], []
            for rep, found in zip(batch.column("id").to_pylist(), batch.column("found"), strict=True):
                own = found.values.to_numpy()
                take = len(own) - -(-percent * len(own) // 100) + 1
                tokens.append(own[np.lexsort((own, counts[own.view(np.uint64) >> np.uint64(64 - BUCKET_BITS)]))[:take]])
                reps.append(np.full(len(tokens[-1]), rep))
                if sum(map(len, reps)) > 1 << 18:
                    yield pa.record_batch([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(reps))], names=["token", "rep"])
                    tokens, reps = [], []
            if reps:
                yield pa.record_batch([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(reps))], names=["token", "rep"])

    return go


def _near(percent: int):
    def go(group: pa.Table) -> pa.Table:
        """The rows of a block of members and one of strays that agree by signature with one of another component, in a pair that belongs to this list."""
        token = group.column("token")[0].as_py()
        stray = group.column("stray").to_numpy().astype(bool)
        component, size = group.column("component").to_numpy(), group.column("n").to_numpy()
        values = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
        flat, first = _lists(group.column("tokens"))
        members, keep = np.flatnonzero(~stray), np.zeros(len(stray), bool)
        for i in np.flatnonzero(stray):
            near = ((values[members] == values[i]).sum(axis=1) >= MATCHES) & (component[members] != component[i])
            near &= 100 * np.minimum(size[members], size[i]) >= percent * np.maximum(size[members], size[i])
            lists = set(flat[first[i] : first[i + 1]].tolist())
            for j in members[near]:
                if not (keep[i] and keep[j]) and next(x for x in flat[first[j] : first[j + 1]].tolist() if x in lists) == token:
                    keep[i] = keep[j] = True
        return group.filter(pa.array(keep))

    return go


def _across(percent: int):
    def go(group: pa.Table) -> pa.Table:
        """Of a block of members and one of strays of a list, links between components: for each stray, one to each component it is linked with.

        A pair belongs to the list of the first token that both have among their long lists, and is looked at there alone.
        """
        token = group.column("token")[0].as_py()
        stray = group.column("stray").to_numpy().astype(bool)
        rep, component = group.column("rep").to_numpy(), group.column("component").to_numpy()
        values = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
        found, start = _lists(group.column("found"))
        found = found.view(np.uint64)  # in this order sets are sorted
        size = np.diff(start)
        flat, first = _lists(group.column("tokens"))
        out: list[tuple[int, int]] = []
        members = np.flatnonzero(~stray)
        for i in np.flatnonzero(stray):
            agree = (values[members] == values[i]).sum(axis=1)
            near = (agree >= MATCHES) & (component[members] != component[i])
            near &= 100 * np.minimum(size[members], size[i]) >= percent * np.maximum(size[members], size[i])
            own, done, lists = found[start[i] : start[i + 1]], set(), set(flat[first[i] : first[i + 1]].tolist())
            for j in members[near][np.argsort(-agree[near], kind="stable")]:
                if component[j] in done or next(x for x in flat[first[j] : first[j + 1]].tolist() if x in lists) != token:
                    continue
                other = found[start[j] : start[j + 1]]
                n = int((own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other).sum())
                if n * 100 >= (len(own) + len(other) - n) * percent:
                    done.add(component[j])
                    out.append((min(rep[i], rep[j]), max(rep[i], rep[j])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})

    return go


def _prefixes(classes: DataFrame) -> DataFrame:
    """(token, many, rep): classes under the rarest of their tokens, with the length of the token's full list; lists of one are dropped."""
    posts = classes.mapInArrow(_tokens, "token long, rep long")
    shared = posts.groupBy(F.col("token").alias("_token")).agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    own = posts.join(shared, F.col("token") == F.col("_token")).groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("many", "token"))).alias("tokens"))  # at most COORDINATES to a class
    take = F.greatest(F.size("tokens") - (MATCHES - COLLISIONS), F.lit(0))
    return own.select("rep", F.explode(F.slice("tokens", F.lit(1), take)).alias("t")).select("t.token", "t.many", "rep")


def _short_pairs(posts: DataFrame, collisions: int) -> DataFrame:
    """Pairs that collide so often on short lists."""
    lists = posts.where(F.col("many") <= SHORT).groupBy("token").agg(F.sort_array(F.collect_list("rep")).alias("reps")).where(F.size("reps") > 1)  # at most SHORT to a list
    pairs = F.flatten(F.transform("reps", lambda b, i: F.transform(F.slice(F.col("reps"), F.lit(1), i), lambda a: F.struct(a.alias("a"), b.alias("b")))))
    return lists.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= collisions).select("a", "b")


def _pivot_pairs(posts: DataFrame) -> DataFrame:
    hot = posts.where(F.col("many") > SHORT)
    draws = [F.xxhash64(F.col("rep"), F.pmod(F.xxhash64("token"), F.lit(8)), F.lit(i)) for i in range(PIVOTS)]
    pivots = hot.groupBy(F.col("token").alias("_token")).agg(F.array_distinct(F.array(*(F.min_by("rep", d) for d in draws))).alias("pivots"))
    # As a table, so that the join's sides are plain exchanges, whose large partitions can be split, or the small one is sent to all.
    pivots = small(written(pivots, "dedup-pivots"), 48)
    near = hot.join(pivots, F.col("token") == F.col("_token")).select("rep", F.explode("pivots").alias("pivot")).where("rep <> pivot")
    return near.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()


def _mixed(posts: DataFrame, found: DataFrame) -> DataFrame:
    """(token, many, rep, component, main, all, most) of the lists that hold more than one component; main is the largest, which has most of all members."""
    named = posts.join(found, F.col("rep") == F.col("node"), "left").select("token", "many", "rep", F.coalesce("component", "rep").alias("component"))
    parts = named.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n"))
    lists = parts.groupBy(F.col("token").alias("_token")).agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("all")).where("all > most")
    lists = small(written(lists, "dedup-lists"), 48)
    return named.join(lists, F.col("token") == F.col("_token")).drop("_token")


def _stray_links(hot: DataFrame, docs: DataFrame, classes: DataFrame, found: DataFrame, words: int, percent: int) -> DataFrame:
    """Links of long lists across components, confirmed on the full sets."""
    sets = _sets_of(_mixed(hot, found).select(F.col("rep").alias("_id")).distinct(), docs, classes, words)
    # One number a bucket, whatever the number of documents.
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for r in sets.mapInArrow(_buckets, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["bucket"]] = r["n"]
    posts = written(sets.mapInArrow(_rarest(counts, percent), "token long, rep long"), "dedup-rarest")
    # Only the long lists are named, so that no task has to meet all rows of one.
    long = posts.groupBy(F.col("token").alias("_token")).agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > SHORT)
    long = small(written(long, "dedup-long"), 32)
    short = posts.join(long, F.col("token") == F.col("_token"), "left_anti").withColumn("many", F.lit(SHORT))
    of = [found.select(F.col("node").alias(f"_n{x}"), F.col("component").alias(f"c{x}")) for x in "ab"]
    pairs = _short_pairs(short, 1).join(of[0], F.col("a") == F.col("_na"), "left").join(of[1], F.col("b") == F.col("_nb"), "left")
    pairs = pairs.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    links = _confirmed(_agreeing_pairs(pairs, classes), sets, percent)
    rows = _mixed(posts.join(long, F.col("token") == F.col("_token")).select("token", "many", "rep"), found)
    rows = rows.select("token", "many", "rep", "component", "main", F.ceil(F.col("all") / BLOCK).alias("blocks"), F.ceil((F.col("all") - F.col("most")) / BLOCK).alias("stray_blocks"))
    rows = written(rows, "dedup-mixed")
    if rows.isEmpty():
        return links
    draw = F.abs(F.xxhash64("rep") % 1_000_003)
    members = rows.select("token", (draw % F.col("blocks")).alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("stray_blocks") - 1)).alias("stray_block"), "rep", "component", F.lit(False).alias("stray"))
    strays = rows.where("component <> main").select("token", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), (draw % F.col("stray_blocks")).alias("stray_block"), "rep", "component", F.lit(True).alias("stray"))
    # What a class brings to each of its lists: signature, size of its set, and its long lists in one order.
    own = rows.groupBy(F.col("rep").alias("_rep")).agg(F.sort_array(F.collect_list(F.struct("many", "token"))).alias("t"))
    own = own.select("_rep", F.transform("t", lambda x: x["token"]).alias("tokens")).join(sets.select("id", F.size("found").alias("n")), F.col("_rep") == F.col("id")).drop("id")
    own = own.join(classes.select(F.col("rep").alias("_r"), "signature"), F.col("_rep") == F.col("_r")).drop("_r")
    signed = members.union(strays).join(own, F.col("rep") == F.col("_rep")).drop("_rep")
    # Sets are many times a signature's size, so only those go to a block that it compares.
    near = written(signed.groupBy("token", "block", "stray_block").applyInArrow(_near(percent), signed.schema), "dedup-near")
    full = near.join(sets, F.col("rep") == F.col("id")).drop("id")
    return links.union(full.groupBy("token", "block", "stray_block").applyInArrow(_across(percent), "a long, b long").distinct())


def _agreeing_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose signatures agree in MATCHES coordinates."""
    signed = [classes.select(F.col("rep").alias(f"_{x}"), F.col("signature").alias(f"s{x}")) for x in "ab"]
    pairs = pairs.join(signed[0], F.col("a") == F.col("_a")).join(signed[1], F.col("b") == F.col("_b"))
    return written(pairs.select("a", "b", "sa", "sb").mapInArrow(_agreeing, "a long, b long"), "dedup-pairs")


def _sets_of(ids: DataFrame, docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(id, found): the full sets of the classes named by ids (_id), made again from their texts."""
    own = classes.select(F.col("rep").alias("_c"), F.col("key").alias("_key")).join(small(written(ids, "dedup-ids"), 16), F.col("_c") == F.col("_id"), "left_semi")
    own = small(written(own, "dedup-keys"), 40)
    rows = docs.join(own, F.col("doc_id") == F.col("_c")).select("doc_id", "_key", "text")
    return written(rows.mapInArrow(_sets(words), "id long, found array<long>"), "dedup-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left, right = (sets.select(F.col("id").alias(f"_{x}"), F.col("found").alias(f"set_{x}")) for x in "ab")
    both = pairs.join(right, F.col("b") == F.col("_b")).join(left, F.col("a") == F.col("_a"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    alike = common * 100 >= (F.size("set_a") + F.size("set_b") - common) * percent
    return both.where(alike).select("a", "b")


def near_duplicates(docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text); links join sets with similarity of at least percent."""
    docs = bounded(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    rows = written(docs.mapInArrow(_signed(words), "doc_id long, n_shingles long, key binary, signature binary"), "dedup-rows")
    # Each step's tables go when the next step has what it reads, so that the disk holds one step at a time.
    spark = docs.sparkSession
    with passing(spark):
        whole = rows.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("signature", ignorenulls=True).alias("signature"))
        classes = written(whole.where("signature is not null and rep is not null"), "dedup-classes")
        posts = written(_prefixes(classes), "dedup-posts")
        with passing(spark):
            pairs = _agreeing_pairs(_short_pairs(posts, COLLISIONS).union(_pivot_pairs(posts)).distinct(), classes)
            sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct(), docs, classes, words)
            links = written(_confirmed(pairs, sets, percent), "dedup-links")
        with passing(spark):
            found = written(components(links), "dedup-components")
        hot = posts.where(F.col("many") > SHORT)
        if not hot.isEmpty():
            with passing(spark):
                more = written(_stray_links(hot, docs, classes, found, words, percent), "dedup-strays")
            if not more.isEmpty():
                with passing(spark):
                    found = written(components(links.union(more)), "dedup-components")
        # A document with an empty set is a component of its own.
        reps = rows.where("n_shingles > 0").groupBy(F.col("key").alias("_key")).agg(F.min("doc_id").alias("rep"))
        reps = reps.join(found, F.col("rep") == F.col("node"), "left").select("_key", F.coalesce("component", "rep").alias("component"))
        reps = written(reps, "dedup-reps")
    named = rows.join(reps, F.col("key") == F.col("_key"), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def deduplicated(docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The docs that are kept, with all their columns; of repeated rows (same doc_id and text) that whose JSON comes first."""
    result = written(near_duplicates(docs, words=words, percent=percent), "dedup-result")
    name = free_prefix(docs) + "id"
    kept = result.where("kept and doc_id is not null")
    gone = result.where("not kept and doc_id is not null").select(F.col("doc_id").alias(name)).distinct()
    twice = kept.groupBy(F.col("doc_id").alias(name)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(name)
    out = docs.join(small(written(gone, "dedup-gone"), 16), F.col("doc_id") == F.col(name), "left_anti")
    twice = written(twice, "dedup-twice")
    if twice.isEmpty():
        return out
    again = small(twice, 16)
    once = out.join(again, F.col("doc_id") == F.col(name), "left_anti")
    row = F.struct(*own(docs))
    several = out.join(again, F.col("doc_id") == F.col(name), "left_semi").groupBy("doc_id", "text").agg(F.min_by(row, F.to_json(row)).alias(name))
    return once.union(several.select(f"{name}.*"))
