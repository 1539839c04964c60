"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

Two words are near if they differ by one inserted, deleted or replaced code point. The edit lies in one half of the
longer word, so near words agree on the other half. Each word therefore enters four groups: with the words of its length
and with those one longer, by its first and by its last half. A group is a key (what stands before and behind the
range in which the edit is sought) and the list of what its words have in that range. A group of more than GROUP_WORDS
words is cut in half again, down to ranges of one code point, where a group is no larger than the alphabet. So no group is unbounded, and every pair meets in the one group
whose range holds the first place at which the two differ.

In a group the list is sorted, and the longest common prefixes of neighbours cut it into ranges that share a prefix.
The edit matrix of a query and a word has a band of three cells per row; the row of a shared prefix is computed once for
the whole range, by the prefix's depth, and goes on to the next rows of the words in it. A range is skipped as soon as no cell
of its row is below two. Only counts and the best near word leave the group, no pairs.

The form of a word is its near word of largest count (ties: least in code-point order) if that count is at least
RATIO times its own; its root is where the forms lead. Counts grow along forms, so they end.

Defined cases: null texts have no words; a null doc_id is an empty text in ``with_typos``; repeated rows count again; words of any
code points and lengths are compared, an empty word too; null words are left out; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtrust.sources.workspace import Workspace

LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
TYPO = 31
GROUP_WORDS, BUCKET_ROWS, CHUNK_ROWS, QUERIES = 20_000, 50_000, 5_000, 2_000
NEAR = "word string, n_near long, n long, form string"


def lower_ascii(word: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    ascii_only = F.octet_length(word) == F.char_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def with_typos(documents: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """Words of at least ``least`` code points of all texts, some of them with one code point deleted.

    Deletion only shortens, so shorter runs of letters are left out at once.
    """
    found = F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))
    runs = documents.select("doc_id", F.explode(found).alias("run")).select("doc_id", lower_ascii(F.col("run")).alias("run"))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    words = runs.withColumn("h", F.crc32(named.cast("binary"))).select(F.when(F.col("h") % TYPO == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= least)


def vocabulary(words: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n of the words met at least ``least_count`` times."""
    return words.where("word IS NOT NULL").groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _halves(rows: DataFrame) -> DataFrame:
    """Cut the range of every row in two: what is left out joins the prefix or the suffix.

    ``short`` words are one code point shorter than the ``width`` of the range and what stands around it.
    """
    middle, short = F.floor(F.col("width") / 2).cast("int"), F.col("short").cast("int")
    rest, end = F.col("rest"), F.col("width")
    first = F.struct(
        F.col("prefix").alias("prefix"),
        F.substring(rest, F.lit(1), middle - short).alias("rest"),
        F.concat(F.substring(rest, middle - short + 1, end), F.col("suffix")).alias("suffix"),
        middle.alias("width"),
    )
    last = F.struct(
        F.concat("prefix", F.substring(rest, F.lit(1), middle)).alias("prefix"),
        F.substring(rest, middle + 1, end).alias("rest"),
        F.col("suffix").alias("suffix"),
        (end - middle).alias("width"),
    )
    parts = F.when(end > 1, F.array(first, last)).otherwise(F.array(last))
    return rows.select("n", "short", F.explode(parts).alias("part")).select("n", "short", "part.*")


def groups(words: DataFrame, workspace: Workspace) -> DataFrame:
    """Rows (n, short, prefix, rest, suffix, width, key) of all words, of which no key has more than GROUP_WORDS."""
    empty, size = F.lit(""), F.char_length("word")
    whole = words.select("n", F.explode(F.array(F.lit(False), F.lit(True))).alias("short"), empty.alias("prefix"), F.col("word").alias("rest"), empty.alias("suffix"), size.alias("size"))
    rows = whole.withColumn("width", F.col("size") + F.col("short").cast("int")).where("width > 0").drop("size")
    done = None
    while True:
        rows = workspace.stage(_halves(rows).withColumn("key", F.xxhash64("prefix", "suffix", "width")), "halves")
        large = workspace.stage(rows.where("width > 1").groupBy("key").agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > GROUP_WORDS).select("key"), "large")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, "key", "left_anti").select(rows.columns)
        done = small if done is None else done.unionByName(small)
        rows = rows.join(large, "key", "left_semi").drop("key")


def common_prefixes(text: np.ndarray, at: np.ndarray, length: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Longest common prefix of every row and the one before it; -1 where a group begins."""
    out = np.where(joined, 0, -1)
    rows = np.flatnonzero(joined)
    depth = 0
    while len(rows):
        rows = rows[(length[rows] > depth) & (length[rows - 1] > depth)]
        rows = rows[text[at[rows] + depth] == text[at[rows - 1] + depth]]
        depth += 1
        out[rows] = depth
    return out


def near_rows(text: np.ndarray, at: np.ndarray, length: np.ndarray, shared: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, word) of rows of one group that are one edit apart, for some query rows.

    Rows are sorted by group and then by their code points, which are ``text[at : at + length]``; ``shared`` are their
    common prefixes.
    """

    def symbol(row: np.ndarray, place: int | np.ndarray) -> np.ndarray:
        inside = (place >= 0) & (place < length[row])
        return np.where(inside, text[np.where(inside, at[row] + place, 0)], 0)

    # Every range of a depth by its first row; the row above it has a shorter common prefix.
    start = np.flatnonzero(shared < 0)
    place = np.searchsorted(start, query, "right") - 1
    before, here, after = np.full(len(query), 2, np.int8), np.zeros(len(query), np.int8), np.where(length[query] > 0, 1, 2).astype(np.int8)
    found_q, found_w, depth = [], [], 0
    while len(query):
        word = start[place]
        over = length[query] - depth
        cell = np.where(over == 0, here, np.where(over == 1, after, np.where(over == -1, before, 2)))
        hit = (length[word] == depth) & (cell == 1)
        found_q.append(query[hit])
        found_w.append(word[hit])
        # Ranges one deeper, which begin where neighbours differ up to there.
        below = np.flatnonzero((shared <= depth) & (length > depth))
        owner = np.searchsorted(start, below, "right") - 1
        first = np.searchsorted(owner, np.arange(len(start)))
        many = np.searchsorted(owner, np.arange(len(start)), "right") - first
        times = many[place]
        pick = np.repeat(np.arange(len(query)), times)
        child = np.repeat(first[place], times) + np.arange(len(pick)) - np.repeat(np.cumsum(times) - times, times)
        q, c0, c1, c2 = query[pick], before[pick], here[pick], after[pick]
        letter = symbol(below[child], depth)
        room = length[q] - depth  # code points of the query from this depth on
        n0 = np.minimum(c0 + (symbol(q, depth - 1) != letter), c1 + 1)
        n1 = np.minimum(np.minimum(c1 + (symbol(q, depth) != letter), c2 + 1), n0 + 1)
        n2 = np.minimum(c2 + (symbol(q, depth + 1) != letter), n1 + 1)
        n0 = np.where(room >= 0, n0, 2)
        n1 = np.where(room >= 1, n1, 2)
        n2 = np.where(room >= 2, n2, 2)
        go = np.minimum(np.minimum(n0, n1), n2) < 2
        query, place = q[go], child[go]
        before, here, after = (np.minimum(x[go], 2).astype(np.int8) for x in (n0, n1, n2))
        start, depth = below, depth + 1
    return np.concatenate(found_q), np.concatenate(found_w)


def prefix_rows(length: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Of every row the first one of the range that shares all but its last code point."""
    out = np.zeros(len(length), np.int64)
    for size in np.unique(length[length > 0]).tolist():
        edge, rows = np.flatnonzero(shared < size - 1), np.flatnonzero(length == size)
        out[rows] = edge[np.searchsorted(edge, rows, "right") - 1]
    return out


def _code_points(column: pa.Array) -> np.ndarray:
    return np.frombuffer("".join(column.to_pylist()).encode("utf-32-le"), np.uint32)


def best_near(table: pa.Table) -> pa.Table:
    """Of every row of a bucket that has near words in its group: their number and the best of them."""
    table = table.sort_by([(c, "ascending") for c in ("prefix", "suffix", "width", "rest")]).combine_chunks()
    same = np.ones(max(table.num_rows - 1, 0), bool)
    for c in ("prefix", "suffix", "width"):
        values = table.column(c)
        same &= pc.equal(values.slice(1), values.slice(0, max(table.num_rows - 1, 0))).to_numpy()
    joined = np.append(np.zeros(1, bool), same)[: table.num_rows]
    crowded = joined | np.append(joined[1:], False)
    table, joined = table.filter(pa.array(crowded)), joined[crowded]
    out = [_best_of(table.slice(a, b - a), joined[a:b]) for a, b in _runs(joined)]
    return pa.concat_tables(out) if out else _no_rows()


def _runs(joined: np.ndarray) -> list[tuple[int, int]]:
    """Whole groups, about CHUNK_ROWS rows at a time."""
    start = np.append(np.flatnonzero(~joined), len(joined))
    out, at = [], 0
    while at < len(joined):
        end = start[max(np.searchsorted(start, at + CHUNK_ROWS, "right") - 1, np.searchsorted(start, at, "right"))]
        out.append((at, int(end)))
        at = int(end)
    return out


def _no_rows() -> pa.Table:
    return pa.table({"word": pa.array([], pa.string()), "n_near": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "form": pa.array([], pa.string())})


def _best_of(table: pa.Table, joined: np.ndarray) -> pa.Table:
    table = table.combine_chunks()
    rest, suffix = (table.column(c).combine_chunks() for c in ("rest", "suffix"))
    text, length = _code_points(rest), pc.utf8_length(rest).to_numpy().astype(np.int64)
    at = np.cumsum(length) - length
    shared = common_prefixes(text, at, length, joined)
    above = prefix_rows(length, shared)
    found = [near_rows(text, at, length, shared, np.arange(i, min(i + QUERIES, len(at)))) for i in range(0, len(at), QUERIES)]
    query, word = (np.concatenate(x) for x in zip(*found, strict=True))
    short, count = table.column("short").to_numpy(), table.column("n").to_numpy()
    keep = ~(short[query] & short[word])
    # A deletion at the range's end may as well be one behind it: that pair belongs to the group of the later range.
    behind = _code_points(pc.utf8_slice_codeunits(suffix, 0, 1))
    has = pc.utf8_length(suffix).to_numpy() > 0
    follows = np.zeros(len(at), np.uint32)
    follows[has] = behind
    mixed = short[query] != short[word]
    long, other = np.where(short[query], word, query), np.where(short[query], query, word)
    last = text[np.maximum(at[long] + length[long] - 1, 0)] if len(text) else np.zeros(len(long), np.uint32)
    keep &= ~(mixed & has[long] & (above[long] == other) & (length[other] == length[long] - 1) & (last == follows[long]))
    query, word = query[keep], word[keep]
    if not len(query):
        return _no_rows()
    words = pc.binary_join_element_wise(table.column("prefix").combine_chunks(), rest, suffix, "")
    rank = pc.rank(words, sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64)
    order = np.lexsort((rank[word], -count[word], query))
    query, word = query[order], word[order]
    first = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
    near = np.diff(np.append(first, len(query)))
    return pa.table({"word": words.take(pa.array(query[first])), "n_near": pa.array(near, pa.int64()), "n": pa.array(count[word[first]], pa.int64()), "form": words.take(pa.array(word[first]))})


def near_words(words: DataFrame, workspace: Workspace) -> DataFrame:
    """word, n_near, best_n and best of every word that has a near one."""
    rows = groups(words, workspace)
    total = rows.count()
    buckets = max(1, -(-total // BUCKET_ROWS))
    dealt = rows.withColumn("bucket", F.pmod("key", F.lit(buckets))).drop("key")
    found = dealt.groupBy("bucket").applyInArrow(lambda table: best_near(table.drop_columns("bucket")), NEAR)
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.form").alias("best"))


def roots(forms: DataFrame, workspace: Workspace) -> DataFrame:
    """form and root: where the forms of every form lead. ``forms`` holds word and form."""
    links = workspace.stage(forms.where("form IS NOT NULL").select("word", "form"), "links")
    at = workspace.stage(links.select("form").distinct().withColumn("root", F.col("form")), "roots")
    onward = links.select(F.col("word").alias("root"), F.col("form").alias("next"))
    while True:
        stepped = at.join(onward, "root", "left")
        at = workspace.stage(stepped.select("form", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if at.where("moved").isEmpty():
            return at.drop("moved")
        at = at.drop("moved")


def spelling_forms(words: DataFrame, workspace: Workspace, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of a vocabulary (word, n)."""
    words = workspace.stage(words.where("word IS NOT NULL").select("word", F.col("n").cast("long").alias("n")), "words")
    met = words.join(near_words(words, workspace), "word", "left")
    taken = F.col("best_n") >= ratio * F.col("n")
    forms = workspace.stage(
        met.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("best")).alias("form"), F.when(taken, F.col("best_n")).alias("form_n")), "forms"
    )
    found = forms.join(roots(forms, workspace), "form", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
