"""URL filter by host word segmentation and naive Bayes (operator 1).

Names in a URL are its runs of letters. Each distinct name is cut into words by the most likely
path under a unigram model of the words on the pages themselves; words of labelled URLs, cut the
same way, train a multinomial naive Bayes model, and a URL is blocked if the log odds of its words
exceed a threshold. Rules given by the user come first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import ship
from barloom.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Longest word, in characters, that a name may hold.
LONGEST = 24
#: Share of the names of labelled URLs in the model of words, whatever the number of words on the pages.
TAUGHT = 0.05
#: Log probability of an unknown piece, without its letters; also apart from the size of the pages.
UNKNOWN = math.log(1e-6)
SMOOTHING = 0.5
#: Log odds from which a URL is blocked: unknown words alone never reach it.
THRESHOLD = 1.0

#: General vocabulary that the query learns from, a line for each subject; another table of
#: (url, blocked) may be passed. Labelled URLs are three neighbouring words of a line each.
BLOCKED = (
    "casino poker roulette jackpot slots blackjack baccarat betting bets wager gambling odds bookmaker lottery bingo dice spins win bonus",
    "pills viagra cialis pharmacy tablets prescription steroids weight loss diet miracle cure cheap discount generic meds",
    "porn adult sex nude xxx erotic escort webcam cams fetish hentai milf strip naked hot girls",
    "spam phishing scam malware virus trojan hack crack keygen warez torrent pirate spoof botnet farm link backlinks",
    "ads banner popup adserver tracker track clicks pixel affiliate sponsor retarget beacon analytics doubleclick free offer prize",
)
ALLOWED = (
    "library books reading author novel poetry essay chapter review archive catalogue journal press editor magazine stories",
    "school lessons teacher student university college course lecture research science physics chemistry biology history maths study",
    "weather news city council local today report radio forecast sports football tennis results league match team",
    "garden roses flowers kitchen recipes cooking bread soup house home furniture paint tools repair craft wood",
    "travel trips hotel train flight map route island mountain lake beach museum gallery theatre music concert",
    "software guide manual help index wiki page forum code data system network computer phone photo video",
    "health doctor hospital advice family children parents nature birds animals dogs horse bank insurance office contact",
)
FRAMES = ("http://{}-{}.test/{}", "https://{}.{}.test/{}.html")


def labelled_urls(lines: tuple[str, ...]) -> list[str]:
    lists = [line.split() for line in lines]
    return [FRAMES[k % 2].format(*(words[(k + j) % len(words)] for j in range(3))) for words in lists for k in range(len(words))]


EXAMPLES = [(url, kind) for kind, lines in ((True, BLOCKED), (False, ALLOWED)) for url in labelled_urls(lines)]


def parts(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path); empty without ``://``."""
    held = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(held, pattern, 1), UPPER, LOWER), F.regexp_extract(held, pattern, 2)


def ruled(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, ties to the smaller string; null without one.
    One condition a rule, so rules are a configuration of up to some hundreds."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def names(host: Column, path: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.concat_ws("/", host, path)), F.lit(r"\p{L}+"), F.lit(0))


def words_of(html: Column) -> Column:
    visible = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_extract_all(F.lower(visible), F.lit(r"\p{L}+"), F.lit(0))


def mixed(read: DataFrame, taught: DataFrame) -> DataFrame:
    """(word, share): a mixture of two unigram models, of pages and of labelled names, of word and n each."""
    total = lambda counts: max(1, counts.agg(F.sum("n")).first()[0] or 0)
    shares = read.select("word", ((1 - TAUGHT) * F.col("n") / total(read)).alias("share"))
    shares = shares.union(taught.select("word", (TAUGHT * F.col("n") / total(taught)).alias("share")))
    return shares.groupBy("word").agg(F.sum("share").alias("share"))


def best_path(name: str, known: list[tuple[int, int, float]], unknown: list[float]) -> list[str]:
    """Viterbi: the cut of ``name`` with the largest sum of log probabilities. ``known``: (begin, length,
    log probability) of the pieces that are words; other pieces cost by their length. Ties to the longer
    last piece."""
    held = {(begin, length): value for begin, length, value in known}
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        top = None
        for length in range(min(LONGEST, end), 0, -1):
            value = best[end - length] + held.get((end - length, length), unknown[length])
            if top is None or value > top[0]:
                top = (value, length)
        best.append(top[0]), back.append(top[1])
    out, end = [], len(name)
    while end:
        out.append(name[end - back[end] : end])
        end -= back[end]
    return out[::-1]


def segmented(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) for every distinct name. ``counts``: word, share, distinct words.

    Only substrings that are words come back from the join, so a name's list is bounded by its own
    length, and the words themselves need not fit in memory.
    """
    ship(found.sparkSession)
    unknown = [0.0] + [UNKNOWN - length * math.log(10) for length in range(1, LONGEST + 1)]
    places = found.select("name", F.explode(F.sequence(F.lit(0), F.length("name") - 1)).alias("begin"))
    lengths = F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("name") - F.col("begin")))
    pieces = places.select("name", "begin", F.explode(lengths).alias("length"))
    pieces = pieces.select("name", "begin", "length", F.substring("name", F.col("begin") + 1, F.col("length")).alias("word"))
    known = pieces.join(counts, "word").select("name", F.struct("begin", "length", F.log("share").alias("value")).alias("piece"))
    known = known.groupBy("name").agg(F.collect_list("piece").alias("pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names_ = batch.column("name").to_pylist()
            cut = [best_path(n, [(p["begin"], p["length"], p["value"]) for p in held or ()], unknown) for n, held in zip(names_, batch.column("pieces").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(names_, pa.string()), pa.array(cut, pa.list_(pa.string()))], names=["name", "words"])

    return found.join(known, "name", "left").select("name", "pieces").mapInArrow(run, "name string, words array<string>")


def trained(labelled: DataFrame, cut: DataFrame) -> DataFrame:
    """(word, odds): log of the word's share in blocked over that in other URLs. ``labelled``: names,
    blocked."""
    words = labelled.select("blocked", F.explode("names").alias("name")).join(cut, "name").select("blocked", F.explode("words").alias("word"))
    counts = words.groupBy("word").agg(F.count_if("blocked").alias("bad"), F.count_if(~F.col("blocked")).alias("good"))
    sums = counts.agg(F.sum("bad"), F.sum("good"), F.count("*")).first()
    bad, good, distinct = (x or 0 for x in sums)
    share = lambda n, total: (F.col(n) + SMOOTHING) / (total + SMOOTHING * max(1, distinct))
    return counts.select("word", F.log(share("bad", bad) / share("good", good)).alias("odds"))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    labelled: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Per row: the id, host, path, rule, verdict, score (log odds of the words), words.

    A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed with
    score 0; so is a url whose words are all unknown. Null pages teach no words. Repeated rows stay
    rows of their own; an empty table stays empty; other columns are not read. ``labelled`` has url and
    blocked (boolean); rows with a null in either are left out.
    """
    spark = pages.sparkSession
    if labelled is None:
        labelled = spark.createDataFrame(EXAMPLES, "url string, blocked boolean")
    host, path = parts(F.col(f"`{url_col}`"))
    urls = pages.select(F.col(f"`{id_col}`"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("names", names(F.col("host"), F.col("path")))
    examples = labelled.where("url is not null and blocked is not null").select(names(*parts(F.col("url"))).alias("names"), "blocked")

    # Pages with the same names share their score: it is worked out once for each set of names.
    sets = urls.select("names").distinct()
    distinct = sets.union(examples.select("names")).select(F.explode("names").alias("name")).distinct()
    taught = examples.select(F.explode("names").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    read = pages.select(F.explode(words_of(F.col(f"`{html_col}`"))).alias("word")).where(F.length("word") <= LONGEST)
    counts = mixed(materialize(read.groupBy("word").agg(F.count("*").alias("n")), "words"), taught)
    cut = materialize(segmented(distinct, counts), "segments")

    odds = trained(examples, cut)
    scores = cut.select("name", "words", F.explode("words").alias("word")).join(odds, "word", "left")
    scores = scores.groupBy("name").agg(F.sum(F.coalesce("odds", F.lit(0.0))).alias("odds"))
    scores = scores.join(cut, "name")
    of_set = sets.select("names", F.posexplode("names").alias("at", "name")).join(scores, "name")
    of_set = of_set.groupBy("names").agg(F.sum("odds").alias("score"), F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("words"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    score = F.coalesce("score", F.lit(0.0))
    said = F.coalesce(verdict, F.when(score > THRESHOLD, "block").otherwise("allow"))
    out = urls.join(of_set, "names", "left")
    return out.select(F.col(f"`{id_col}`"), "host", "path", rule.alias("rule"), said.alias("verdict"), score.alias("score"), F.coalesce("words", F.array().cast("array<string>")).alias("words"))
