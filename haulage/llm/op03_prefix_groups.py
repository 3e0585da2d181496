"""N-gram Jaccard join by grouped prefixes, and its link classes.

A document's set holds its distinct 5-word shingles. Documents with equal sets
are one set from the start (a set's key is a 64-bit sum hash and its size).
Two sets link when 100 * intersection >= 80 * union. The join runs in steps,
each exact, that leave less and less to do:

1. Every set sends the first tokens of its hash order (its prefix of length
   n - ceil(0.8 n) + n/10). Linked sets share at least n/10 of those, so a set
   whose prefix has fewer tokens in common with others links with nothing.
   This takes about 30 % of the tokens and drops most documents.
2. For the rest, document frequencies give the global order, rare first. A
   set with fewer than 0.8 n tokens that another set has is dropped; the
   others keep their prefix in that order.
3. Sets with the same prefix and size form a group. Groups that share a
   prefix token and whose sizes allow a link are candidate group pairs.
4. Group pairs are expanded and verified. First some groups of each token
   meet all others of the token, in rounds that are linear in the token's
   sets. What is linked then needs no more tests inside its class. Last,
   every candidate pair whose members are still in different classes is
   verified if the tokens from the shared one onwards can suffice in both
   sets; at the first token that a linked pair shares, they do. So no link
   between classes is missed.

Edge rows: a null or empty text, or one of white space, has no shingles and
links with nothing. With fewer than five words the whole sequence is the one
shingle. Repeated rows have equal sets and come back each. A row with a null id
comes back and links like others but never names a class; a class of such rows
only has a null class id. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm.blocked_bloom import may_hold
from haulage.llm.common import WHITE, annotate, chunks, lean, mix, prepare, shingles_of, store, text_buffer, words_of
from haulage.llm.components import components
from haulage.llm.registry import query, table

SHARE = 80            # two sets link at this many hundredths of their union
SLACK = 10            # the first step's prefix is longer by n / SLACK tokens
ROUNDS = 2            # rounds of one set per token before all pairs between classes are tested
LOCAL = 8             # a token in this many sets of a batch is counted in the batch
MAX_BLOCKS = 1 << 20  # words of the filter before the text join: 8 MiB


def needed(n):
    """Tokens that a set of n must share with a set that it links with, at least."""
    return (SHARE * n + 99) // 100


def slack(n):
    return np.maximum(1, n // SLACK)


def sets_of(texts: pa.Array):
    """Distinct shingles of a batch: (row, hash) sorted by both, sizes and keys of the rows."""
    data, off = text_buffer(texts)
    rows, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for a, b in chunks(off):
        _, _, row, word = words_of(data[off[a]:off[b]], off[a:b + 1] - off[a], ~WHITE)
        row, h, _ = shingles_of(row, word, b - a)
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
        rows.append(row[new] + a)
        hashes.append(h[new])
    row, h = np.concatenate(rows), np.concatenate(hashes)
    n = np.bincount(row, minlength=len(texts)).astype(np.int64)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(0x5851F42D4C957F2D)))))
    ends = np.concatenate(([0], np.cumsum(n)))
    return row, h, n, total[ends[1:]] - total[ends[:-1]]


def _prefix_rows(batches):
    """(token, sig, w): w = 1 for a token to look up, 0 for a witness, -c for c tokens known to be shared."""
    for batch in batches:
        row, h, n, sig = sets_of(batch.column(0))
        _, first = np.unique(sig, return_index=True)
        once = np.zeros(len(n), bool)
        once[first] = True
        once &= n > 0
        begin = np.cumsum(n) - n
        take = np.minimum(n, n - needed(n) + slack(n))
        inside = once[row] & (np.arange(len(row)) - begin[row] < take[row])
        token, owner = h[inside].view(np.int64), sig[row[inside]].view(np.int64)
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(token)))
        hot = np.repeat(size >= LOCAL, size)
        at = np.arange(len(token)) - np.repeat(start, size)
        known, times = np.unique(owner[hot], return_counts=True)
        keep = ~hot | (at < 2)
        token = np.concatenate((token[keep], known))
        owner = np.concatenate((owner[keep], known))
        w = np.concatenate(((~hot[keep]).astype(np.int32), -times.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(owner), pa.array(w, pa.int32())], names=["token", "sig", "w"])


def _shared_rows(batches):
    """(sig, shared) sums over rows sorted by token; a token is shared if its rows have two keys."""
    token0 = sig0 = None  # the run that the last batch ended in
    pending, open_run = 0, False
    for batch in batches:
        token, sig, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        known = w < 0
        out_sig, out_w = [sig[known]], [-w[known].astype(np.int64)]
        token, sig, w = token[~known], sig[~known], w[~known].astype(np.int64)
        if len(token):
            start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
            low, high = np.minimum.reduceat(sig, start), np.maximum.reduceat(sig, start)
            shared = low != high
            goes_on = token0 is not None and token[0] == token0
            if goes_on:
                shared[0] |= open_run or low[0] != sig0
                if shared[0] and not open_run and pending:
                    out_sig.append(np.array([sig0], np.int64))
                    out_w.append(np.array([pending], np.int64))
            size = np.diff(np.append(start, len(token)))
            take = np.repeat(shared, size) & (w > 0)
            out_sig.append(sig[take])
            out_w.append(w[take])
            before = pending if goes_on and len(start) == 1 and not shared[0] else 0
            token0, sig0, open_run = token[-1], sig[-1], bool(shared[-1])
            pending = before + int(w[start[-1]:].sum())
        total_sig, total_w = np.concatenate(out_sig), np.concatenate(out_w)
        if len(total_sig):
            keys, where = np.unique(total_sig, return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, where, total_w)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["sig", "shared"])


def _keys():
    def fn(texts):
        _, _, n, sig = sets_of(texts)
        return [pa.array(sig.view(np.int64)), pa.array(n)]
    return fn


def _tokens():
    def fn(texts):
        _, h, n, sig = sets_of(texts)
        ends = np.concatenate(([0], np.cumsum(n)))
        return [pa.array(sig.view(np.int64)), pa.array(n),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h.view(np.int64)))]
    return fn


def _verified(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Those pairs (a, b) that link."""
    left = tokens.select(F.col("sig").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = tokens.select(F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    common = F.size(F.array_intersect("ta", "tb"))
    return (pairs.join(left, "a").join(right, "b").withColumn("common", common)
            .where(100 * F.col("common") >= SHARE * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b"))


def _pairs(frame: DataFrame) -> DataFrame:
    return frame.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _sizes_allow(a: str, b: str):
    return 100 * F.least(a, b) >= SHARE * F.greatest(a, b)


def _open_rows(expanded: DataFrame, comp: DataFrame) -> DataFrame:
    """Prefix rows with their class, of the tokens that still have more than one."""
    rows = (expanded.join(comp, F.col("sig") == F.col("node"), "left")
            .select("token", "sig", "n", "left", F.coalesce("comp", "sig").alias("class")))
    several = rows.groupBy("token").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("token")
    return store(rows.join(several, "token", "left_semi"), "open-rows")


def _merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (node, comp) after further links between sets; a set without a class is its own."""
    label = lambda side: comp.select(F.col("node").alias(side), F.col("comp").alias(f"c{side}"))
    found = store(links, "links")
    if found.isEmpty():
        return comp
    upper = components(found.join(label("a"), "a", "left").join(label("b"), "b", "left")
                       .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))).toDF("below", "top")
    return store(comp.join(upper, F.col("comp") == F.col("below"), "full")
                 .select(F.coalesce("node", "below").alias("node"), F.coalesce("top", "comp").alias("comp")), "classes")


def link_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, class_id, row_key, stays), one row per row of ``docs``.

    ``class_id`` is the smallest id that links reach, the row's own included.
    ``row_key`` is a hash of id and text; ``stays`` marks the rows to keep if
    one document of each class is to stay (repeated rows are marked alike).
    """
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    keyed = src.select("id", "text", F.xxhash64("id", "text").alias("row_key"))
    sets = store(annotate(keyed, "text", _keys, "sig long, n long", keep=["id", "row_key"]), "sets")

    # 1. sets whose prefix has enough tokens that other sets have too
    shared = (src.select("text").mapInArrow(lean(_prefix_rows), "token long, sig long, w int")
              .repartition("token").sortWithinPartitions("token")
              .mapInArrow(lean(_shared_rows), "sig long, shared long").groupBy("sig").agg(F.sum("shared").alias("shared")))
    least = F.floor((SHARE * F.col("n") + 99) / 100)
    reps = (sets.where("n > 0").groupBy("sig", "n").agg(F.min("row_key").alias("rep")).join(shared, "sig")
            .where(F.col("shared") >= F.greatest(F.lit(1), F.floor(least / SLACK))).select("sig", "n", "rep"))
    reps = store(reps, "candidates")
    wanted = reps.select("rep").distinct()
    blocks = min(MAX_BLOCKS, max(64, 1 << (wanted.count() // 4).bit_length()))
    # the filter keeps most texts out of the join's shuffle; of repeated rows one is left, so each set is there once
    texts = (keyed.select("row_key", "text").where(may_hold(F.col("row_key"), wanted, "rep", blocks))
             .dropDuplicates(["row_key"]).join(wanted, F.col("row_key") == F.col("rep"), "left_semi"))
    tokens = store(annotate(texts, "text", _tokens, "sig long, n long, tokens array<long>", keep=[]), "tokens")

    # 2. rare-first prefixes of the sets that have enough tokens in common with others
    by_token = tokens.select("sig", "n", F.explode("tokens").alias("token"))
    frequent = by_token.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    prefixes = (by_token.join(frequent, "token").groupBy("sig", "n")
                .agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
                .where(F.size("t") >= least)
                .select("sig", "n", F.size("t").cast("long").alias("s"),
                        F.expr(f"transform(slice(t, 1, size(t) - cast(floor(({SHARE} * n + 99) / 100) as int) + 1),"
                               " x -> x.token)").alias("prefix")))

    # 3. groups of equal prefix and size (such sets have as many common tokens, too)
    prefixes = store(prefixes.dropDuplicates(["sig", "n"]), "prefixes")
    groups = store(prefixes.groupBy("n", "s", "prefix").agg(F.min("sig").alias("gid")), "groups")
    members = store(prefixes.join(groups, ["n", "s", "prefix"]).select("sig", "n", "gid"), "members")
    # left: tokens of the set that are not before this one in the global order
    group_tokens = store(groups.select("gid", "n", "s", F.posexplode("prefix").alias("at", "token"))
                         .select("gid", "n", (F.col("s") - F.col("at")).alias("left"), "token"), "group-tokens")

    # 4a. within groups, and each token's outermost groups against its others
    ends = group_tokens.groupBy("token").agg(F.min(F.struct("n", "gid")).alias("lo"), F.max(F.struct("n", "gid")).alias("hi"))
    met = group_tokens.join(ends.where("lo.gid <> hi.gid"), "token")
    star = None
    for end in ("lo", "hi"):
        part = (met.where((F.col("gid") != F.col(f"{end}.gid")) & _sizes_allow("n", f"{end}.n"))
                .select(F.col("gid").alias("a"), F.col(f"{end}.gid").alias("b")))
        star = part if star is None else star.unionByName(part)
    inside = members.where("sig <> gid").select(F.col("sig").alias("a"), F.col("gid").alias("b"))
    comp = components(_verified(_pairs(star.unionByName(inside)), tokens))

    # 4b. more rounds: a set of each token, by a hash, against those in other classes
    expanded = group_tokens.join(members.select("gid", "sig"), "gid").select("token", "sig", "n", "left")
    for turn in range(ROUNDS):
        rows = _open_rows(expanded, comp)
        pivot = rows.groupBy("token").agg(F.min_by(F.struct("sig", "n", "class"), F.xxhash64("sig", "token", F.lit(turn))).alias("p"))
        near = (rows.join(pivot, "token").where((F.col("class") != F.col("p.class")) & _sizes_allow("n", "p.n"))
                .select(F.col("sig").alias("a"), F.col("p.sig").alias("b")))
        comp = _merged(comp, _verified(_pairs(near), tokens))

    # 4c. every candidate pair between classes; one side is outside its token's largest class
    rows = _open_rows(expanded, comp)
    most = (rows.groupBy("token", "class").agg(F.count("*").alias("c")).groupBy("token")
            .agg(F.max_by("class", F.struct("c", "class")).alias("most")))
    few = (rows.join(most, "token").where("class <> most")
           .select("token", F.col("sig").alias("a"), F.col("n").alias("na"), F.col("left").alias("la"), F.col("class").alias("ca")))
    every = rows.select("token", F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("left").alias("lb"), F.col("class").alias("cb"))
    # at the first token that two linked sets share, both still hold all that they share
    enough = 100 * F.least("la", "lb") * (100 + SHARE) >= 100 * SHARE * (F.col("na") + F.col("nb"))
    across = few.join(every, "token").where((F.col("ca") != F.col("cb")) & _sizes_allow("na", "nb") & enough)
    comp = _merged(comp, _verified(_pairs(across), tokens)).toDF("sig", "class")

    # class ids: sets without a link are classes of their own, empty documents stay alone
    named = (sets.join(comp.distinct(), "sig", "left")
             .select("id", "row_key", "n", F.when(F.col("n") > 0, F.coalesce("class", "sig")).alias("class")))
    named = store(named, "named")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("row_key")))
    smallest = named.where("class is not null").groupBy("class").agg(first.alias("first"))
    linked = F.col("n") > 0
    return (named.join(smallest, "class", "left")
            .select("id", F.col("n").alias("n_shingles"), F.when(linked, F.col("first.id")).otherwise(F.col("id")).alias("class_id"),
                    "row_key", (~linked | (F.col("row_key") == F.col("first.row_key"))).alias("stays")))


SQL = """
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w from documents),
s as (select doc_id, list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
             when len(w) > 0 then [array_to_string(w, ' ')] else [] end) sh from w),
u as (select doc_id, unnest(sh) t from s),
c as (select a.doc_id a, b.doc_id b, count(*) common from u a join u b on a.t = b.t and a.doc_id < b.doc_id group by all),
l as (select a, b from c join s x on x.doc_id = a join s y on y.doc_id = b where 100 * common >= 80 * (len(x.sh) + len(y.sh) - common)),
e as (select a, b from l union select b, a from l),
r as (select doc_id, doc_id reached from s union select r.doc_id, e.b from r join e on e.a = r.reached)
select s.doc_id, len(any_value(s.sh))::bigint n_shingles, min(r.reached) component_id from s join r using (doc_id) group by s.doc_id"""


@query("op3_jaccard_classes", SQL)
def op3_jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = link_classes(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("class_id").alias("component_id"))
