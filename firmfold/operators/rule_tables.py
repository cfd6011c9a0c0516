"""Classification by rule tables of any size: rules are joined, never collected.

A keyword occurs in a text only if its longest piece (a run of letters and digits, or of
other characters) occurs in one of the text's pieces. So keywords are matched with the
*vocabulary*, the distinct pieces of all texts, which grows far slower than the texts:

* a whole word's piece equals a piece of the vocabulary: an equi-join;
* a stem's piece lies inside one: a stem of up to ``GRAM`` characters begins one of its ends;
  what is longer is joined on its rarest run of ``GRAM``, then tested.

What is left is an equi-join of the texts' pieces with the matched pieces. Keywords of one
piece are decided by it; others are tested on the text. Texts are told apart by a 64-bit and
a 32-bit hash of their content, so equal texts are classified once, and no row needs an id.

Groups of rules (a category and its name) are numbered in rule order. What a keyword names is
a set of numbers, kept as bits; unions of sets travel from ends to pieces to texts, so what is
shuffled does not grow with the rules that a text meets. Rules are read when an operator is
called: numbers and sets are staged, so that the planner knows their size.

Joins whose sides both follow the data are hinted to shuffle: their sizes are estimated from
compressed files and before lists are taken apart, and a side that was planned as a broadcast
stays one, however large it turns out to be. Every task gets the ids of all groups, in one row.

The results equal those of :mod:`firmfold.functions.classify` for the same rules; small
fixed rule sets stay expressions there. Blanks around whole words are cut.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmfold.functions.classify import POSTCODE
from firmfold.functions.text import fold_text, js_trim
from firmfold.session import staged

PIECE = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
GRAM = 8
# The last digits of a number that one window sorts, and how many characters below the surrogates a code uses.
STEP, UNITS = 4, 55_000
# A row of a set holds this many words of 64 numbers.
WORDS = 8
_KEY, _TOKEN, _WORDS = ["_h1", "_h2"], ["_t1", "_t2"], [f"_b{i}" for i in range(WORDS)]


@dataclass(frozen=True)
class RuleTables:
    """Rule tables as :func:`firmfold.functions.rules.load_rules` takes them, left where they are."""

    categories: DataFrame            # category, name, ord, keyword, whole_word
    regions: DataFrame               # region_id, name, ord, keyword
    prefixes: DataFrame | None = None  # scheme, prefix, category, ord
    capital: str = "budapest"
    # The ids stay in their table; merging takes all ids as they come.
    category_ids = ()


def _content_key(content: Column, names: list[str] = _KEY) -> list[Column]:
    return [F.xxhash64(content).alias(names[0]), F.hash(content).alias(names[1])]


def _pieces(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)))


def _shuffled(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join of which no side goes through the driver."""
    return left.join(right.hint("merge"), on, how)


def _runs(text: Column, length: Column) -> Column:
    """The distinct runs of a length; none where the text is shorter."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - length + 1, F.lit(1)))
    return F.when(F.length(text) >= length, F.array_distinct(F.transform(
        starts, lambda i: F.substring(text, i, length)))).otherwise(F.array().cast("array<string>"))


def _set(number: Column) -> list[Column]:
    """(chunk, words) of the set of one number."""
    place = number % (64 * WORDS)
    word = F.floor(place / 64)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
    return [F.floor(number / (64 * WORDS)).alias("chunk"),
            *[F.when(word == i, bit).otherwise(F.lit(0).cast("bigint")).alias(c) for i, c in enumerate(_WORDS)]]


def _union(rows: DataFrame, *by: str) -> DataFrame:
    """The union of the sets of equal keys, a row per chunk."""
    return rows.groupBy(*by, "chunk").agg(*[F.bit_or(c).alias(c) for c in _WORDS])


def _groups(rules: DataFrame, id_col: str, group: list[str]) -> DataFrame:
    """(group, place, id, n): the groups of rules, numbered by where their first rule stands."""
    places = rules.groupBy(*group).agg(F.min("ord").alias("place")).dropna(subset=group).withColumn("id", F.col(id_col))
    order = Window.orderBy(F.col("place").asc_nulls_first(), "id", *group)
    return staged(places.withColumn("n", F.row_number().over(order) - 1), "groups")


def _keywords(rules: DataFrame, groups: DataFrame, group: list[str]) -> DataFrame:
    """(keyword, whole, piece, equal, decides, chunk, words): the groups that each keyword names."""
    rules = rules.select(*group, "keyword", "whole").filter("keyword is not null and whole is not null")
    numbers = rules.join(groups.select(*group, "n"), group)
    folded = fold_text(F.col("keyword"))
    # Each value is made once per distinct keyword: it passes through an explode of one value,
    # so that filters on it are not planned as copies of it, on every rule.
    rows = _union(numbers.select("keyword", "whole", *_set(F.col("n"))), "keyword", "whole").select(
        F.explode(F.array(F.when(F.col("whole"), js_trim(folded)).otherwise(folded))).alias("keyword"), "whole", "chunk", *_WORDS)
    longest = F.array_max(F.transform(_pieces(F.col("keyword")), lambda p: F.struct(F.length(p).alias("n"), p.alias("piece"))))
    rows = _union(rows.filter(js_trim(F.col("keyword")) != ""), "keyword", "whole").select(
        "*", F.explode(F.array(longest["piece"])).alias("piece"))
    # A whole word's letters and digits stand between other characters; its signs need not.
    equal = F.col("whole") & F.col("piece").rlike(r"^[\p{L}\p{N}]")
    decides = (F.col("piece") == F.col("keyword")) & (equal | ~F.col("whole"))
    return staged(rows.withColumns({"equal": equal, "decides": decides}), "keywords")


def _stem_sets(vocabulary: DataFrame, stems: DataFrame) -> DataFrame:
    """(token's key, chunk, words) of the stems (piece, chunk, words) of up to ``GRAM`` characters in a token.

    A token holds a stem where one of its ends begins with it. Ends are cut to the longest stem,
    so that many tokens share them: each distinct one meets the stems once, and the union of
    what it holds is what travels to the tokens.
    """
    # One row, of at most GRAM numbers.
    lengths = stems.agg(F.collect_set(F.length("piece")).alias("lengths"))
    starts = F.sequence(F.lit(1), F.length("token") - F.array_min("lengths") + 1)
    ends = F.when(F.length("token") >= F.array_min("lengths"), F.array_distinct(F.transform(
        starts, lambda i: F.substring(F.col("token"), i, F.array_max("lengths")))))
    pairs = vocabulary.crossJoin(lengths).select(*_TOKEN, F.explode(ends).alias("end"))
    begins = F.transform(F.filter("lengths", lambda n: n <= F.length("end")), lambda n: F.substring(F.col("end"), F.lit(1), n))
    pieces = pairs.select("end").distinct().crossJoin(lengths).select("end", F.explode(begins).alias("piece"))
    held = _union(_shuffled(pieces, stems, "piece"), "end")
    return _union(_shuffled(pairs, held, "end"), *_TOKEN)


def _matched_pieces(vocabulary: DataFrame, keywords: DataFrame) -> DataFrame:
    """(token, keyword, whole, decides): pieces of texts that hold a keyword's piece."""
    names = ["token", "keyword", "whole", "decides"]
    equal = keywords.filter("equal").withColumn("token", F.col("piece")).select(names)
    inner = keywords.filter(~F.col("equal"))
    parts = inner.select("piece").distinct()
    long = F.length("piece") > GRAM
    # One row, of at most GRAM numbers: only runs of a length that a stem has are made.
    lengths = parts.agg(F.collect_set(F.least(F.length("piece"), F.lit(GRAM))).alias("lengths"))
    every = F.flatten(F.transform("lengths", lambda n: _runs(F.col("token"), n)))
    held = vocabulary.select("token").crossJoin(lengths).select("token", F.explode(every).alias("run"))
    wanted = parts.filter(long).select("piece", F.explode(_runs(F.col("piece"), F.lit(GRAM))).alias("run"))
    # A run that no text holds rules its stem out: the inner join drops it, so it must be counted as none.
    counts = _shuffled(held, wanted.select("run").distinct(), "run", "left_semi").groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    rarest = _shuffled(wanted, counts, "run", "left").groupBy("piece").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("run"))).alias("best"))
    sought = parts.filter(~long).select("piece", F.col("piece").alias("run")).unionByName(
        rarest.select("piece", F.col("best.run").alias("run")))
    # A piece is sought by one run, and a token holds a run once: each pair is found once.
    found = _shuffled(held, sought, "run").filter(F.col("token").contains(F.col("piece"))).select("token", "piece")
    return equal.unionByName(_shuffled(found, inner, "piece").select(names))


def _hit_sets(texts: DataFrame, keywords: DataFrame) -> DataFrame:
    """(``_h1``, ``_h2``, chunk, words) of the keywords in every distinct text; a text has several rows.

    ``texts``: folded ``hay`` with its key.
    """
    sets = keywords.select("keyword", "whole", "chunk", *_WORDS)
    plain = ~F.col("whole") & F.col("decides") & (F.length("piece") <= GRAM)
    others = keywords.filter(~plain).select("keyword", "whole", "piece", "equal", "decides").distinct()
    pieces = texts.select(*_KEY, F.explode(_pieces(F.col("hay"))).alias("token"))
    vocabulary = pieces.select("token").distinct().select("token", *_content_key(F.col("token"), _TOKEN))
    tokens = pieces.select(*_KEY, *_content_key(F.col("token"), _TOKEN)).distinct()
    matched = _matched_pieces(vocabulary, others).select(*_content_key(F.col("token"), _TOKEN), "keyword", "whole", "decides")
    sure = _shuffled(matched.filter("decides"), sets, ["keyword", "whole"]).select(*_TOKEN, "chunk", *_WORDS)
    of_token = _stem_sets(vocabulary, keywords.filter(plain).select("piece", "chunk", *_WORDS)).unionByName(sure)
    named = _shuffled(tokens, of_token, _TOKEN).select(*_KEY, "chunk", *_WORDS)
    # Other keywords are tested on the text, to which they travel as lists of each token. A list is
    # made by one column more than it is joined on, so that the join has shuffles of its own, which
    # can be split where a token stands in most texts.
    lists = matched.filter(~F.col("decides")).groupBy(*_TOKEN, "whole").agg(F.collect_list("keyword").alias("asked"))
    asked = _shuffled(_shuffled(tokens, lists, _TOKEN).select(*_KEY, "whole", "asked"), texts.dropDuplicates(_KEY), _KEY)
    pattern = lambda k: F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), k, F.lit(r"\E(?![\p{L}\p{N}])"))
    holds = lambda k: F.col("hay").contains(k) & (~F.col("whole") | F.regexp_like(F.col("hay"), pattern(k)))
    tested = asked.select(*_KEY, F.explode(F.filter("asked", holds)).alias("keyword"), "whole").distinct()
    return named.unionByName(_shuffled(tested, sets, ["keyword", "whole"]).select(*_KEY, "chunk", *_WORDS))


def _named(held: Column, groups: Column) -> Column:
    """The ids of sets, in order: an id stands at the least place of its groups."""
    of_word = lambda h, i: F.filter(
        F.slice(groups, (h["chunk"] * (64 * WORDS) + 64 * i + 1).cast("int"), F.lit(64)), lambda g, at: F.bit_get(h[_WORDS[i]], at) == 1)
    found = F.flatten(F.transform(held, lambda h: F.concat(*[of_word(h, i) for i in range(WORDS)])))
    # A group without a place comes first, but does not place its id.
    placed = lambda f: F.filter(f, lambda g: g["place"].isNotNull())["id"]
    others = lambda f: F.filter(f, lambda g: g["place"].isNull())["id"]
    ids = lambda f: F.when(F.get(f, F.lit(0))["place"].isNull(), F.concat(
        F.array_except(others(f), placed(f)), F.array_distinct(placed(f)))).otherwise(F.array_distinct(f["id"]))
    return F.when(held.isNotNull(), F.get(F.transform(F.array(found), ids), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _with_ids(rows: DataFrame, hay: Column, rules: DataFrame, id_col: str, group: list[str]) -> DataFrame:
    """The rows with ``_ids``, the ids that their text names, in rule order.

    A frequent keyword stands in many rules, and a text holds many keywords of one id: what
    travels to the text is sets of numbers, as bits, and ids stand there only at the end.
    """
    keyed = rows.withColumn("_hay", F.coalesce(hay, F.lit(""))).select("*", *_content_key(F.col("_hay")))
    texts = keyed.select(*_KEY, F.col("_hay").alias("hay")).filter("hay <> ''")
    groups = _groups(rules, id_col, group)
    hits = _union(_hit_sets(texts, _keywords(rules, groups, group)).repartition(*_KEY), *_KEY)
    held = hits.groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("chunk", *_WORDS))).alias("_held"))
    # One row, of all groups: numbers become ids when no list has to be sorted or shuffled any more.
    listed = groups.agg(F.sort_array(F.collect_list(F.struct("n", "place", "id"))).alias("_groups"))
    return _shuffled(keyed.drop("_hay"), held, _KEY, "left").crossJoin(listed).withColumn(
        "_ids", _named(F.col("_held"), F.col("_groups"))).drop(*_KEY, "_held", "_groups")


def classify_by_rules(rows: DataFrame, tables: RuleTables, hay: Column, out: str = "categories") -> DataFrame:
    """The rows with the ids of all categories whose keywords their folded text holds, in rule order."""
    rules = tables.categories.withColumn("whole", F.col("whole_word").cast("boolean"))
    found = _with_ids(rows, hay, rules, "category", ["category", "name"])
    return found.withColumn(out, F.col("_ids")).drop("_ids")


def regions_by_rules(rows: DataFrame, tables: RuleTables, hay: Column, out: str = "region_id") -> DataFrame:
    """The rows with the region of a folded address: 1xxx postcode, capital by name, then rule order."""
    rules = tables.regions.withColumn("whole", F.lit(False))
    found = _with_ids(rows.withColumn("_place", hay), F.col("_place"), rules, "region_id", ["region_id", "name"])
    coded = F.regexp_extract("_place", POSTCODE, 1).startswith("1")
    capital = F.coalesce(coded, F.lit(False)) | F.array_contains("_ids", tables.capital)
    return found.withColumn(out, F.when(capital, F.lit(tables.capital)).otherwise(F.get("_ids", F.lit(0)))).drop("_ids", "_place")


def _coded(categories: DataFrame) -> DataFrame:
    """(category, n, code): the categories in their order, each with a short text that sorts as it does."""
    last = Window.orderBy(F.col("category").asc_nulls_first())
    numbered = categories.select("category").distinct().select("category", (F.row_number().over(last) - 1).alias("n"))
    unit = lambda n: F.decode(F.unhex(F.lpad(F.hex(n + 1), 4, "0")), "UTF-16BE")
    high = F.when(F.count(F.lit(1)).over(Window.partitionBy()) > UNITS, unit(F.floor(F.col("n") / UNITS))).otherwise("")
    return staged(numbered.select("category", "n", F.concat(high, unit(F.col("n") % UNITS)).alias("code")), "codes")


def _decoded(codes: Column, names: Column, width: Column) -> Column:
    """The names of codes that stand side by side, each once."""
    units = F.split(codes, "")
    pairs = F.transform(F.sequence(F.lit(1), F.floor(F.size(units) / 2).cast("int")), lambda i: F.substring(codes, 2 * i - 1, F.lit(2)))
    place = lambda c: F.ascii(c) - 1 + F.when(width > 1, (F.ascii(c) - 1) * (UNITS - 1) + F.ascii(F.substring(c, 2, 1)) - 1).otherwise(0)
    each = F.array_distinct(F.when(width > 1, pairs).otherwise(units))
    return F.when(F.length(codes) > 0, F.transform(each, lambda c: F.get(names, place(c)))).otherwise(F.array().cast("array<string>"))


def _along_prefixes(numbers: DataFrame, rules: DataFrame, width: int) -> DataFrame:
    """(text, named): what the rules (text, ord, code) say of each number (text), in order of ``ord``.

    Sorted, a prefix stands before the numbers that begin with it. So numbers and prefixes of
    one head, which is all but the last ``STEP`` digits, lie in one window, and the prefix of a
    length that counts is the last one met: lists are read where they are, none is shuffled to
    each number. A head has 11,111 texts at most. Prefixes no longer than a head are met by the
    heads first, which are few.
    """
    if width <= STEP:
        starts = numbers.select("text", F.explode(F.transform(
            F.sequence(F.lit(0), F.length("text")), lambda n: F.substring(F.col("text"), F.lit(1), n))).alias("prefix"))
        found = _shuffled(starts, rules.withColumnRenamed("text", "prefix"), "prefix")
        return found.groupBy("text").agg(F.sort_array(F.collect_list(F.struct("ord", "code"))).alias("named"))
    low = width - STEP
    head = F.substring("text", 1, low)
    above = _along_prefixes(numbers.select(head.alias("text")).distinct(), rules.filter(F.length("text") <= low), low)
    above = above.select("text", F.inline("named")).groupBy("text", "code").agg(F.min(F.struct("ord")).alias("first"))
    entries = rules.filter(F.length("text") > low).select("text", "ord", "code").unionByName(
        above.select("text", "first.ord", "code")).withColumn("asked", F.lit(False))
    none = [F.lit(None).cast(rules.schema[n].dataType).alias(n) for n in ("ord", "code")]
    rows = entries.unionByName(numbers.select("text", *none, F.lit(True).alias("asked"))).repartition(head)
    rows = rows.groupBy(head.alias("head"), "text").agg(
        F.sort_array(F.collect_list(F.when(F.col("code").isNotNull(), F.struct("ord", "code")))).alias("own"), F.max("asked").alias("asked"))
    before = Window.partitionBy("head").orderBy("text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A text that is shorter than a head is its own head.
    lengths = range(low, width + 1)
    rows = rows.select("text", "asked", *[
        F.last(F.when(F.greatest(F.length("text"), F.lit(low)) == n, F.struct("text", "own")), ignorenulls=True).over(before).alias(f"of_{n}")
        for n in lengths]).filter("asked")
    fits = [F.when(F.col(f"of_{n}.text") == F.substring("text", 1, n), F.col(f"of_{n}.own")) for n in lengths]
    empty = F.array().cast(rows.schema[f"of_{low}"].dataType["own"].dataType)
    return rows.select("text", F.sort_array(F.concat(*[F.coalesce(f, empty) for f in fits])).alias("named"))


def codes_by_rules(rows: DataFrame, prefixes: DataFrame, known: DataFrame | None, codes: Column, digits: int,
                   out: str = "categories") -> DataFrame:
    """The rows with the categories of their codes: code order first, then rule order.

    ``prefixes``: prefix, category, ord; ``known``: the categories that count. Only numbers of
    up to ``digits`` digits occur, so no other prefix is read further. What travels to a row is
    a text of about a character per category; names are looked up at the end.
    """
    number = lambda c: F.substring(F.regexp_replace(c, "[^0-9]", ""), 1, digits)
    numbers = F.transform(F.filter(codes, lambda c: c.isNotNull()), number)
    keyed = rows.withColumn("_numbers", F.coalesce(numbers, F.array().cast("array<string>"))).select(
        "*", *_content_key(F.col("_numbers")))
    coded = _coded(prefixes if known is None else known.filter("category is not null"))
    can_fit = F.col("prefix").rlike(rf"^[0-9]{{0,{digits}}}\z")
    usable = prefixes.filter(can_fit).alias("p").join(coded.alias("c"), F.col("p.category").eqNullSafe(F.col("c.category"))).groupBy(
        F.col("prefix").alias("text"), "code").agg(F.min("ord").alias("ord"))
    contents = keyed.select(*_KEY, "_numbers").distinct()
    each = contents.select(*_KEY, F.posexplode(F.array_distinct("_numbers")).alias("at", "text"))
    named = _along_prefixes(each.select("text").distinct(), usable, digits).filter(F.size("named") > 0)
    found = named.select("text", F.array_join(F.array_distinct("named.code"), "").alias("codes"))
    # A content has a row per number at most: it is collected where its rows meet, not before.
    lists = _shuffled(each, found, "text").select(*_KEY, "at", "codes").repartition(*_KEY).groupBy(*_KEY).agg(
        F.sort_array(F.collect_list(F.struct("at", "codes"))).alias("_lists"))
    names = coded.agg(F.sort_array(F.collect_list(F.struct("n", "category"))).alias("_names"), F.max(F.length("code")).alias("_width"))
    ids = _decoded(F.coalesce(F.array_join("_lists.codes", ""), F.lit("")), F.col("_names.category"), F.col("_width"))
    return _shuffled(keyed, lists, _KEY, "left").crossJoin(names).withColumn(out, ids).drop(
        *_KEY, "_numbers", "_lists", "_names", "_width")
