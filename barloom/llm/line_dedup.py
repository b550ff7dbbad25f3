"""Fuzzy line dedup in DataFrame operations alone (operator 7).

Lines are normalised to words and equal ones grouped. The SimHash of a line has ``BLOCKS`` blocks of 64
bits. The features of a block are ``FEATURES`` words of the line, each the first in an order of hashes
of its own (words of ``LONG_WORD`` letters or more before shorter ones), and each of its bits is the
majority of theirs. So an edit leaves a block alone unless it touches the few words that the block
looks at, while these together still tell lines apart: lines that share a block, the pigeonholes, are
candidates. Their edit similarity (edits of whole words) has to be ``SIMILARITY`` or more, and one
occurrence of each connected group stays.

A block may be common to a large share of all lines, so its list does not make pairs:

1. every line of a list is compared with the list's first one;
2. in lists whose lines are then still in different groups, those outside the largest group, if they
   are few (``CROWDED``), are compared with the lines of other groups;
3. if they are many, the lines of the list are posted again under their rarest words there. Of two
   similar lines the longer, of n words, lacks at most n / 5 of the other's, and that one fewer by the
   difference in length; so a common word stands among so many and one more of the rarest of each: no
   pair is lost, and what a page template has in common brings nothing together. Steps 1 and 2 follow
   for these lists, step 2 for any number, of pairs with a word at such a rank in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import free_names
from barloom.llm.components import connected_components
from barloom.session import materialize

#: Lines of fewer words are compared for equality alone.
MIN_WORDS = 5
SIMILARITY = 0.8
BLOCKS, FEATURES, LONG_WORD = 4, 3, 5
#: Lines outside a list's largest group that are compared with all of the list, at most.
CROWDED = 64
#: What separates words besides single spaces: other white space, these marks, several spaces.
MARKS = r"""\t\r\f\x0B.,;:!?"'()"""
#: Words with single spaces between them, and what then separates them from the next: whole words are
#: passed over at once, and a match begins where the last one ended, so that none is tried twice. (Java
#: takes plain runs of a class faster than possessive ones; they cannot give back here.)
APART = rf"\G([^ {MARKS}]*(?: [^ {MARKS}]+)*+)[ {MARKS}]+"
#: Texts and hashes hardly repeat: no dictionary, and the compression that takes the least time.
WRITTEN = {"parquet.enable.dictionary": "false", "parquet.compression.codec.zstd.level": "1"}
#: Flags that keep what cannot match out of a shuffle.
FLAGS = 1 << 18
#: For a side of few columns with one row a key: the other, of postings or texts, is not sorted then.
HASHED = "shuffle_hash"


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(at, doc, pos, norm, k1, k2): the lines that hold a word, numbered, as words in lower case with
    single spaces between them; k1 and k2 are 128 bits of hash of norm.

    Lines are lowered one by one, as those of ASCII alone, which most are, take much less. What has no
    word is told from the line as it stands, so that the planner does not normalise it twice.
    """
    lines = docs.select(F.col(f"`{id_col}`").alias("doc"), F.posexplode(F.split(F.col(f"`{text_col}`"), "\n")).alias("pos", "line"))
    held = lines.where(F.col("line").rlike(f"[^ {MARKS}]"))
    norm = held.select("doc", "pos", F.trim(F.regexp_replace(F.lower("line"), APART, "$1 ")).alias("norm"))
    return norm.select(F.monotonically_increasing_id().alias("at"), "doc", "pos", "norm", F.xxhash64("norm").alias("k1"), F.xxhash64(F.lit(7), "norm").alias("k2"))


def turned(word: str, number: int) -> Column:
    """A hash of the word that gives it its place in order ``number``: long words are negative."""
    h, quarter = F.col(f"hash_{number // 4}"), 16 * (number % 4)
    if quarter:
        h = F.shiftleft(h, quarter).bitwiseOR(F.shiftrightunsigned(h, 64 - quarter))
    return F.when(F.length(word) >= LONG_WORD, h.bitwiseOR(F.lit(-(1 << 63)))).otherwise(h.bitwiseAND(F.lit((1 << 63) - 1)))


def majority(a: Column, b: Column, c: Column) -> Column:
    return a.bitwiseAND(b).bitwiseOR(a.bitwiseAND(c)).bitwiseOR(b.bitwiseAND(c))


def distinct_lines(lines: DataFrame) -> DataFrame:
    """One row per distinct line: its number (the smallest of its occurrences), k1, k2, how often it
    occurs, and of lines of ``MIN_WORDS`` words or more the size (number of words) and the SimHash."""
    split = lines.select("at", "k1", "k2", F.length("norm").alias("chars"), F.split("norm", " ").alias("words"))
    # Outer, or the planner splits again to see whether there are words.
    words = split.select("at", "k1", "k2", "chars", F.size("words").alias("size"), F.posexplode_outer("words").alias("nth", "word"))
    # Long words come first in every order, so the others matter only where there may be no long one.
    short = F.col("chars") < LONG_WORD * F.col("size")
    words = words.where((F.col("nth") == 0) | (F.length("word") >= LONG_WORD) | short)
    orders = range(BLOCKS * FEATURES)
    words = words.select("*", *[F.xxhash64("word", F.lit(k)).alias(f"hash_{k}") for k in range(-(-len(orders) // 4))])
    # A line's words are in one task, so each line is one row before the shuffle; copies have equal values.
    looked = words.groupBy("k1", "k2").agg(
        F.min("at").alias("line"),
        F.count(F.when(F.col("nth") == 0, 1)).alias("times"),
        F.max("size").alias("size"),
        *[F.min(turned("word", k)).alias(f"first_{k}") for k in orders],
    )
    blocks = F.array(*[majority(*[F.col(f"first_{FEATURES * k + j}") for j in range(FEATURES)]) for k in range(BLOCKS)])
    compared = F.col("size") >= MIN_WORDS
    return looked.select("line", "k1", "k2", "times", F.when(compared, F.col("size")).alias("size"), F.when(compared, blocks).alias("blocks"))


def posted(unique: DataFrame) -> DataFrame:
    """(key, line, size): lines under their blocks."""
    placed = unique.select("line", "size", F.posexplode("blocks").alias("k", "block"))
    return placed.select(F.xxhash64("k", "block").alias("key"), "line", "size")


def spelled(norm: Column) -> Column:
    """The line with one character for each word (by hash, one of some 53,000), so that the edit
    distance of characters is that of words."""
    letters = F.transform(F.split(norm, " "), lambda w: F.lpad(F.hex(F.pmod(F.xxhash64(w), F.lit(0xD000)) + 0x100), 4, "0"))
    return F.decode(F.unhex(F.array_join(letters, "")), "UTF-16BE")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of line numbers whose lines have the edit similarity. ``texts``: line, spelled.
    If the pairs have b's ``size``, pairs of sizes that do not fit go no further than a's text."""
    left = texts.select(F.col("line").alias("a"), F.col("spelled").alias("na"))
    right = texts.select(F.col("line").alias("b"), F.col("spelled").alias("nb"))
    most = f"cast(floor({1 - SIMILARITY:.6f}D * greatest(length(na), length(nb)) + 1e-9D) as int)"
    halves = pairs.distinct().join(left, "a")
    if "size" in pairs.columns:
        halves = halves.where(fits(F.length("na"), "size"))
    return halves.join(right, "b").where(f"levenshtein(na, nb, {most}) >= 0").select("a", "b")


def fits(a: Column | str, b: Column | str) -> Column:
    """Sizes that the similarity allows."""
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def shared(postings: DataFrame) -> DataFrame:
    """(key, line, size, members, head): the postings of lists with two lines or more; of just two, if
    their sizes fit."""
    sizes = F.min("size").alias("least"), F.max("size").alias("most")
    lists = postings.groupBy("key").agg(F.count("*").alias("members"), F.min("line").alias("head"), *sizes)
    lists = lists.where((F.col("members") > 2) | (F.col("members") == 2) & fits("least", "most")).drop("least", "most")
    return materialize(postings.join(materialize(lists, "lists").hint(HASHED), "key"), "shared")


def with_heads(held: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between the lines of lists and their first ones."""
    return verified(held.where("head != line").select(F.col("head").alias("a"), F.col("line").alias("b"), "size"), texts)


def grown(groups: DataFrame | None, links: DataFrame) -> DataFrame:
    """(line, component): the groups with new links (a, b). Only what these join is looked at again:
    each group is one node, so earlier links are not gone over."""
    if groups is None:
        return materialize(connected_components(links, "a", "b").select(F.col("node").alias("line"), "component"), "groups")
    ends = links.select(F.col("a").alias("line")).union(links.select("b")).distinct().join(groups, "line", "left_anti")
    groups = groups.union(ends.select("line", F.col("line").alias("component")))
    of = lambda end: groups.select(F.col("line").alias(end), F.col("component").alias(f"group_{end}"))
    joined = connected_components(links.join(of("a"), "a").join(of("b"), "b"), "group_a", "group_b").toDF("component", "into")
    return materialize(groups.join(joined, "component", "left").select("line", F.coalesce("into", "component").alias("component")), "groups")


def mixed(held: DataFrame, groups: DataFrame) -> DataFrame:
    """Lines of lists that hold different groups: their ``component``, the list's ``largest`` and the
    number of ``strays`` outside it. Lists of two are done."""
    grouped = held.where("members > 2").join(groups, "line", "left").withColumn("component", F.coalesce("component", "line"))
    grouped = materialize(grouped, "grouped")
    sizes = grouped.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("all"))
    several = largest.select("key", F.col("most.component").alias("largest"), (F.col("all") - F.col("most.n")).alias("strays")).where("strays > 0")
    return materialize(grouped.drop("members").join(several, "key"), "mixed")


def across(open_: DataFrame) -> DataFrame:
    """Pairs of lines of one list and different groups, one of them a stray at least; two strays once.
    Where the list is that of a word, its rank has to be one that the sizes allow in both."""
    ranked = ["rank"] if "rank" in open_.columns else []
    named = lambda end: ["key", *[F.col(c).alias(f"{c}_{end}") for c in ("line", "size", "component", *ranked)]]
    a = open_.where("component != largest").select(*named("a"))
    b = open_.select(*named("b"), (F.col("component") == F.col("largest")).alias("settled"))
    wanted = (F.col("component_a") != F.col("component_b")) & fits("size_a", "size_b") & (F.col("settled") | (F.col("line_a") < F.col("line_b")))
    if ranked:
        longer = F.greatest("size_a", "size_b")
        for end in "ab":  # words that the line may lack
            wanted &= F.col(f"rank_{end}") <= F.call_function("div", longer, F.lit(5)) - (longer - F.col(f"size_{end}"))
    return a.join(b, "key").where(wanted).select(F.least("line_a", "line_b").alias("a"), F.greatest("line_a", "line_b").alias("b"))


def rarest(crowd: DataFrame) -> DataFrame:
    """(key, line, size, rank): lines of crowded lists (key, line, size, spelled), posted under their rarest words in the list."""
    held = crowd.select("key", "line", "size", F.array_distinct(F.split("spelled", "")).alias("words"))
    # Any order of a list's words will do: those of its first line, and so what a template has, come last and need no count.
    often = materialize(held.groupBy("key").agg(F.sort_array(F.min_by("words", "line")).alias("often")), "often")
    places = F.call_function("div", F.col("size"), F.lit(5)).cast("int") + 1
    last = F.slice(F.array_intersect("often", "words"), F.lit(1), places)
    split = held.join(often, "key").select("key", "line", "size", F.array_except("words", "often").alias("seldom"), last.alias("last"))
    split = materialize(split, "split")
    counts = split.select("key", F.explode("seldom").alias("word")).groupBy("key", "word").agg(F.count("*").alias("n"))
    words = split.select("key", "line", "size", F.explode("seldom").alias("word")).join(counts, ["key", "word"])
    nth = F.row_number().over(Window.partitionBy("key", "line").orderBy("n", "word")) - 1  # among a line's words
    first = words.select("key", "line", "size", nth.alias("rank"), "word").where(F.col("rank") < places)
    left = split.where(F.size("seldom") < places).select("key", "line", "size", F.size("seldom").alias("before"), F.posexplode("last").alias("nth", "word"))
    last = left.select("key", "line", "size", (F.col("before") + F.col("nth")).alias("rank"), "word").where(F.col("rank") < places)
    posted = first.union(last)
    return posted.select(F.xxhash64("key", "word").alias("key"), "line", "size", "rank")


def groups_of(unique: DataFrame, lines: DataFrame) -> DataFrame:
    """(line, component): the groups of two distinct lines or more that similar lines on a common
    block make; the component is the smallest line."""
    held = shared(posted(unique))
    # The texts of lines that share a list; no other text moves again.
    named = lines.select(F.col("at").alias("line"), "norm").join(held.select("line").distinct().hint(HASHED), "line", "left_semi")
    texts = materialize(named.select("line", spelled(F.col("norm")).alias("spelled")), "texts", **WRITTEN)
    groups = grown(None, with_heads(held, texts))
    open_ = mixed(held, groups)
    few, crowd = open_.where(F.col("strays") <= CROWDED), open_.where(F.col("strays") > CROWDED)
    near = verified(across(few), texts)
    if crowd.isEmpty():
        return grown(groups, materialize(near, "links"))
    crowd = materialize(texts.join(crowd.select("key", "line", "size"), "line"), "crowd")
    texts = crowd.select("line", "spelled").distinct()
    held = shared(materialize(rarest(crowd), "rarest"))
    groups = grown(groups, materialize(near.union(with_heads(held, texts)), "links"))
    return grown(groups, materialize(verified(across(mixed(held, groups)), texts), "links"))


def links(unique: DataFrame, lines: DataFrame) -> DataFrame:
    """(a, b): links between distinct lines that connect all that similar lines on a common block do."""
    return groups_of(unique, lines).select(F.col("component").alias("a"), F.col("line").alias("b")).where("a != b")


def removed_lines(lines: DataFrame) -> DataFrame:
    """(doc, pos, kept_doc, kept_pos): occurrences that go, and the one that stays for them."""
    lines = materialize(lines, "lines", "zstd", **WRITTEN)  # texts are normalised once
    unique = materialize(distinct_lines(lines), "distinct", "zstd", **WRITTEN)
    classes = unique.select("line", "k1", "k2", "times").join(groups_of(unique, lines).hint(HASHED), "line", "left")
    classes = classes.where("times > 1 or component is not null").select("k1", "k2", F.coalesce("component", "line").alias("component"))
    repeats = materialize(lines.select("doc", "pos", "k1", "k2").join(classes.hint(HASHED), ["k1", "k2"]).select("doc", "pos", "component"), "repeats")
    # Written, so that the planner can split a component with many lines.
    kept = materialize(repeats.groupBy("component").agg(F.min(F.struct("doc", "pos")).alias("kept")), "kept")
    placed = repeats.join(kept.hint(HASHED), "component").select("doc", "pos", F.col("kept.doc").alias("kept_doc"), F.col("kept.pos").alias("kept_pos"))
    return placed.where(~(F.col("doc").eqNullSafe(F.col("kept_doc")) & (F.col("pos") == F.col("kept_pos"))))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = False) -> DataFrame:
    """The rows with the lines that repeat elsewhere taken out of ``text``; other columns as they were.

    Of each group of similar lines the occurrence with the smallest id, then the smallest line number,
    stays, wherever the others are. Lines of fewer than ``MIN_WORDS`` words are similar only if their
    words are the same; lines without words stay. Null texts stay null, a text all of whose lines go
    becomes empty. Rows of one id count as one document: they lose the same line numbers. An empty
    table stays empty. ``counts`` adds n_lines and n_removed, in place of columns of these names.
    """
    doc, at, flag, left_text = free_names(docs.columns, "__doc", "__gone", "__flag", "__text")
    gone = removed_lines(lines_of(docs, id_col, text_col)).groupBy("doc").agg(F.collect_set("pos").alias("gone"))  # at most a document's lines
    gone = materialize(gone.select(F.col("doc").alias(doc), F.col("gone").alias(at)), "gone")
    # Documents that cannot lose a line do not go through the join's shuffle.
    flags = F.broadcast(gone.select(F.pmod(F.xxhash64(doc), F.lit(FLAGS)).alias(flag)).distinct())
    flagged = docs.withColumn(flag, F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(FLAGS)))
    whole = flagged.join(flags, flag, "left_anti").drop(flag).withColumn(at, F.lit(None).cast("array<int>"))
    some = flagged.join(flags, flag, "left_semi").drop(flag)
    # Shuffled at every size, as it has to be where ``gone`` is large.
    some = some.join(gone.hint(HASHED), some[id_col].eqNullSafe(gone[doc]), "left").drop(doc)
    both = whole.unionByName(some)
    text = F.col(f"`{text_col}`")
    left = F.filter(F.split(text, "\n"), lambda line, pos: ~F.array_contains(at, pos))
    out = both.withColumn(left_text, F.when(F.col(at).isNull(), text).otherwise(F.array_join(left, "\n")))
    if counts:
        breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
        out = out.withColumn("n_lines", F.coalesce(breaks + 1, F.lit(0))).withColumn("n_removed", F.coalesce(F.size(at), F.lit(0)))
    order = list(dict.fromkeys([*docs.columns, *(["n_lines", "n_removed"] if counts else [])]))
    return out.select(*[F.col(left_text).alias(c) if c == text_col else F.col(f"`{c}`") for c in order])
