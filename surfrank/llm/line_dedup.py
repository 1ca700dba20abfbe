"""Line dedup by a deletion-neighbourhood join.

A line is its words; blank lines are kept and not compared.  Equal lines
are one.  Two lines of at least ``min_words`` words are also alike when one
becomes the other by inserting, deleting or replacing few words (edit
distance over words): one word, and with ``words_per_edit`` one for each
that many words of the shorter line, without an upper end.  A line goes if
an equal or alike line stands earlier, in order of doc_id (null last), then
place in the document.

1. Every line gives a hash of its words; the first place of each hash is
   found by an aggregation.
2. A line that can be alike to another one agrees with it in its first or
   its last half, cut for its own length or that of a line with a word
   less.  Only lines for which such a half key occurs in two different
   lines go on (no line that is alike to another is lost).
3. These emit their deletion neighbourhood as hashed keys: the line with
   word i left out for each i, and the line itself.  Equal keys join: a
   line and another one less a word, or two lines less their i-th words.
   The hashes of all variants come from running XORs over (word, place), so
   a line costs in proportion to its length.
4. For each line the earliest partner is verified by edit distance over the
   words, and the lines that stay are put together again.

Within a key the rows stream by in order of their places and each sees only
the earliest one before it; pairs of a group are never listed and no group
is held in memory.  Only DataFrame functions.

Where two or more edits are allowed (k = words // ``words_per_edit``), a line
is cut into parts at words that their hash picks, about three in eight. An edit
takes at most two parts, so in any one order of all parts two alike lines share
one of the first 2 k + 1 of each, and one more for each further one. Lines that
share enough of their longest parts go on. Of these the rarest parts are the
keys: a part that no other line of like length has is not shared, and a line
with more than 2 k of them has no alike line. A line of too few parts gives its
word pairs (neighbouring words) too, of which an edit also takes two at most.
Within a key, sketches (for each of 256 bits, whether an odd number of words has
it; an edit changes two) leave the pairs that are verified by edit distance: each
line first with the earliest one of the key, those that this does not settle
with all earlier ones. Pairs that the sketches rule out are compared within the
join and not written; their number still grows with the square of a key's group.

Cases: null text stays null and has no lines; repeated rows (same id and
text) are one document; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, cut

MIN_WORDS = 8
KEYS = "array<struct<key:bigint,kind:int>>"
WIDE = 1 << 20
#: Numbers of 64 bits in a line's sketch.
SKETCH = 4
#: Keys of a line of which alike lines share one more each.
MORE = 2


def _plain(text: Column) -> Column:
    """The text with one space between the words of a line and none at its ends; most texts are so already."""
    odd = text.startswith(" ") | text.endswith(" ")
    for c in ("  ", " \n", "\n ", *SPACES.replace("\n", "")[1:]):
        odd |= text.contains(c)
    single = F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")
    return F.when(odd, F.trim(F.regexp_replace(single, " ?\n ?", "\n"))).otherwise(text)


def _has_word(line: Column) -> Column:
    return F.ltrim(line, F.lit(SPACES)) != ""


def _words(plain: Column) -> Column:
    return F.split(plain, " ")


def _lines(rows: DataFrame) -> DataFrame:
    """at, rank, place, plain, line (hash), n of every line that is not blank."""
    lines = rows.select("at", "rank", F.posexplode(F.split(_plain(F.col("text")), "\n")).alias("place", "plain")).filter("plain != ''")
    spaces = F.octet_length("plain") - F.octet_length(F.replace("plain", F.lit(" "), F.lit("")))
    return lines.withColumns({"line": F.xxhash64("plain"), "n": spaces + 1})


def _halves(words: Column, n: Column) -> Column:
    """Keys of the first and last half, cut for the length n and for n - 1."""
    out = []
    for length in (n, n - 1):
        head = F.floor(length / 2).cast("int")
        tail = length - head
        out.append(F.xxhash64(F.lit("head"), length, F.slice(words, 1, head)))
        out.append(F.xxhash64(F.lit("tail"), length, F.slice(words, n - tail + 1, tail)))
    return F.array(*out)


def _variants(lines: DataFrame) -> DataFrame:
    """key, kind, ord: the deletion neighbourhood of lines (ord, words).

    kind 0: the line itself, as others less a word may equal it; 1: the
    line less a word; 2: the line less its word i, with i, for replacement.
    """
    words = lines.select("ord", F.size("words").alias("n"), F.posexplode("words").alias("i", "word")).select(
        "ord", "n", "i", F.xxhash64("word", "i").alias("here"), F.xxhash64("word", F.col("i") - 1).alias("moved")
    )
    line = Window.partitionBy("ord").orderBy("i")
    upto = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_words = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    less = words.select(
        "ord",
        "n",
        "i",
        F.bit_xor("here").over(all_words).alias("whole"),
        F.bit_xor("here").over(upto).bitwiseXOR(F.col("here")).alias("ahead"),
        F.bit_xor("moved").over(all_words).bitwiseXOR(F.bit_xor("moved").over(upto)).alias("after"),
    ).withColumn("left", F.col("ahead").bitwiseXOR(F.col("after")))
    keys = F.array(
        F.struct(F.xxhash64(F.col("left"), F.col("n") - 1).alias("key"), F.lit(1).alias("kind")),
        F.struct(F.xxhash64(F.col("left"), F.col("n") - 1, F.col("i")).alias("key"), F.lit(2).alias("kind")),
    )
    whole = F.when(F.col("i") == 0, F.array(F.struct(F.xxhash64("whole", "n").alias("key"), F.lit(0).alias("kind"))))
    return less.select("ord", F.explode(F.concat(keys, F.coalesce(whole, F.array().cast(KEYS)))).alias("k")).select("k.key", "k.kind", "ord")


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two arrays of words are within one insertion, deletion or replacement."""
    na, nb = F.size(a), F.size(b)
    least = F.least(na, nb)
    same = F.when(least > 0, F.zip_with(F.slice(a, 1, least), F.slice(b, 1, least), lambda x, y: x == y)).otherwise(F.array().cast("array<boolean>"))
    at = F.array_position(same, False)  # 1-based place of the first difference, 0: none
    at = F.when(at == 0, least + 1).otherwise(at).cast("int")

    def rest(words: Column, n: Column, skip: Column) -> Column:
        return F.slice(words, at + skip, F.greatest(n - at - skip + 1, F.lit(0)))

    more_a, more_b = (na >= nb).cast("int"), (nb >= na).cast("int")
    return (F.abs(na - nb) <= 1) & (rest(a, na, more_a) == rest(b, nb, more_b))


def _number(letters: Column, *of: Column) -> Column:
    """A number that rises as the letters get fewer, then by hash."""
    fewer = F.lit(1023).cast("long") - F.least(letters, F.lit(1023)).cast("long")
    return F.shiftleft(fewer, 53).bitwiseOR(F.shiftrightunsigned(F.xxhash64(*of), 11))


def _pair_numbers(words: Column, n: Column) -> Column:
    """A number for each pair of neighbouring words."""

    def pairs(w: Column) -> Column:  # the words as a variable, or they would be split for each pair
        return F.zip_with(F.slice(w, 1, n - 1), F.slice(w, 2, n - 1), lambda a, b: _number(F.octet_length(a) + F.octet_length(b), a, b))

    return F.transform(F.array(words), pairs)[0]


def _part_numbers(words: Column) -> Column:
    """A number for each part; about three words in eight, told by their hash, begin a part, and so does the first."""
    begins = F.transform(words, lambda w: F.when(F.xxhash64(w).bitwiseAND(F.lit(7)) < 3, F.concat(F.lit("\n"), w)).otherwise(w))
    # a space ends each part, the last one too; what stands before a first word that begins a part is no part
    parts = F.split(F.ltrim(F.concat(F.array_join(begins, " "), F.lit(" ")), F.lit("\n")), "\n")
    return F.transform(parts, lambda x: _number(F.octet_length(x), x))


def _first_keys(numbers: Column, most: Column) -> Column:
    return F.array_distinct(F.slice(F.sort_array(numbers), 1, most))


def _pair_keys(words: Column, n: Column, most: Column) -> Column:
    """Negative, so that they are told from the numbers of parts."""
    return F.transform(_first_keys(_pair_numbers(words, n), most), F.bitwise_not)


def _most(n: Column, per: int) -> Column:
    """Parts or pairs of which two alike lines share one: an edit takes at most two."""
    return 2 * F.floor(n / per).cast("int") + 1


def _as_text(numbers: Column) -> Column:
    """A string with one character for each number below ``WIDE``."""
    return F.decode(F.unhex(F.array_join(F.transform(numbers, lambda x: F.lpad(F.hex(x + 0x10000), 8, "0")), "")), "UTF-32")


def _near(a: str, b: str, na: str, nb: str, per: int) -> Column:
    """Whether two strings of a character per word are within the edits allowed for the shorter."""
    return F.expr(f"levenshtein({a}, {b}, cast(least({na}, {nb}) div {per} as int)) >= 0")


def _few_edits(pairs: DataFrame, chosen: DataFrame, per: int) -> DataFrame:
    """ord of those ``pairs`` (ord, earlier) that are alike; ``chosen``: ord, n, plain."""
    pairs = cut(pairs)
    needed = pairs.select("ord").union(pairs.select("earlier")).distinct()
    words = cut(chosen.join(needed, "ord", "left_semi").select("ord", "n", _words(F.col("plain")).alias("words")))
    other = words.select(F.col("ord").alias("earlier"), F.col("n").alias("n_b"), F.col("words").alias("words_b"))
    both = pairs.join(words, "ord").join(other, "earlier")

    def numbered(own: str, alone: int) -> Column:
        """Common words by their place in the list of these, others as ``alone``."""
        common = F.array(F.array_intersect("words", "words_b"))
        at = F.transform(common, lambda known: F.transform(F.col(own), lambda w: F.array_position(known, w)))[0]
        return _as_text(F.transform(at, lambda x: F.when(x == 0, alone).otherwise(x + 1)))

    def hashed(own: str) -> Column:
        return F.transform(own, lambda w: F.xxhash64(w).bitwiseAND(F.lit(WIDE - 1)))

    told = both.withColumns({"h": hashed("words"), "h_b": hashed("words_b")})
    # mostly no two words of the lines have the same hash; else their places tell them
    apart = F.size(F.array_distinct(F.concat("words", "words_b"))) == F.size(F.array_distinct(F.concat("h", "h_b")))
    told = told.withColumn("apart", apart).select(
        "ord",
        "n",
        "n_b",
        F.when(F.col("apart"), _as_text(F.col("h"))).otherwise(numbered("words", 0)).alias("a"),
        F.when(F.col("apart"), _as_text(F.col("h_b"))).otherwise(numbered("words_b", 1)).alias("b"),
    )
    return told.filter(_near("a", "b", "n", "n_b", per)).select("ord").distinct()


def _within(per: int) -> str:
    """Whether the next shorter or longer line of a key is within the edits; if not these, none is."""
    return f"n - less <= less div {per} or more - n <= n div {per}"


def _rare_keys(chosen: DataFrame, per: int) -> DataFrame:
    """key, ord, n: of each line's parts the rarest ones of which two alike lines share one.

    Parts that no line of like length shares come first and give no row; a line
    with too many of them has no alike one.
    """
    n, words, most = F.col("n"), _words(F.col("plain")), _most(F.col("n"), per)
    parts = chosen.select("ord", "n", "plain", _part_numbers(words).alias("parts"))
    pairs = F.when(F.size("parts") < most, _pair_keys(words, n, most)).otherwise(F.array())
    parts = parts.select("ord", "n", pairs.alias("pairs"), F.array_distinct("parts").alias("parts"))
    rows = parts.select("ord", "n", F.size("parts").alias("m"), F.explode(F.concat("parts", "pairs")).alias("key"))
    by_key = Window.partitionBy("key").orderBy("n", "ord")
    rows = rows.withColumns({"less": F.lag("n").over(by_key), "more": F.lead("n").over(by_key)})
    rows = rows.withColumn("lines", F.count("*").over(by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    by_line = Window.partitionBy("ord").orderBy(F.col("key") < 0, "lines", "key")
    rows = rows.filter(_within(per)).withColumn("at", F.row_number().over(by_line))
    shared = F.count(F.when(F.col("key") >= 0, 1)).over(by_line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.withColumn("shared", shared).filter((F.col("key") < 0) | (F.col("m") - F.col("shared") + F.col("at") <= most)).select("key", "ord", "n")


def _many_edits(chosen: DataFrame, per: int) -> DataFrame:
    """line of the lines that an alike line precedes."""
    sketches = [f"s{i}" for i in range(SKETCH)]
    bits = F.transform(_words(F.col("plain")), lambda w: F.xxhash64(w).bitwiseAND(F.lit(64 * SKETCH - 1)))
    # bit by bit whether an odd number of words has it; an edit changes at most two
    odd = [F.expr(f"aggregate(bits, 0L, (s, b) -> if(shiftright(b, 6) = {i}, s ^ shiftleft(1L, int(b)), s))").alias(x) for i, x in enumerate(sketches)]
    held = cut(_rare_keys(chosen, per).join(chosen.select("ord", bits.alias("bits")).select("ord", *odd), "ord"))
    differ = " + ".join(f"bit_count({x} ^ {x}_b)" for x in sketches)
    maybe = f"abs(n - n_b) <= least(n, n_b) div {per} and {differ} <= 2 * (least(n, n_b) div {per})"
    ahead = Window.partitionBy("key").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    firsts = held.withColumn("first", F.first(F.struct("ord", "n", *sketches)).over(ahead))
    firsts = firsts.select("ord", "n", *sketches, F.col("first.ord").alias("earlier"), *[F.col(f"first.{x}").alias(f"{x}_b") for x in ("n", *sketches)])
    firsts = cut(firsts.filter(maybe).select("ord", "earlier").distinct())
    settled = cut(_few_edits(firsts, chosen, per))
    later = held.join(settled, "ord", "left_anti")
    before = held.select("key", F.col("ord").alias("earlier"), *[F.col(x).alias(f"{x}_b") for x in ("n", *sketches)])
    pairs = later.join(before, "key").filter(f"earlier < ord and {maybe}").select("ord", "earlier").distinct()
    more = _few_edits(pairs.join(firsts, ["ord", "earlier"], "left_anti"), chosen, per)
    return settled.unionByName(more).join(chosen, "ord").select("line")


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, words_per_edit: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_equal, n_alike, text.

    Alike lines differ by one word, or with ``words_per_edit`` (3 or more) by
    at most max(1, words of the shorter // ``words_per_edit``).

    ``n_lines`` counts lines that are not blank, ``n_equal`` and ``n_alike``
    those that go because an equal or an alike line stands earlier; ``text``
    is the text without them.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("at", F.xxhash64("doc_id", "text")).withColumn("rank", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id"))
    lines = _lines(rows)
    place = F.struct("rank", "at", "place")

    if words_per_edit is not None and words_per_edit < 3:
        raise ValueError("words_per_edit must be 3 or more")
    n, words = F.col("n"), _words(F.col("plain"))
    by_half = n >= min_words
    if words_per_edit:
        least = max(2 * words_per_edit, min_words)  # words of a line that may differ by two
        by_half &= n <= least
    keyed = lines.withColumn("halves", F.when(by_half, _halves(words, n)))
    if words_per_edit:
        keyed = keyed.withColumn("parts", F.when(n >= least, F.array_distinct(_part_numbers(words))))
        most = _most(n, words_per_edit)
        keys = _first_keys(F.col("parts"), most + MORE)
        few = F.size("parts") < most
        keyed = keyed.withColumn("keys", F.when(few, F.concat(keys, _pair_keys(words, n, most))).otherwise(keys))
        keyed = keyed.withColumn("need", F.when(few, 1).otherwise(F.size("keys") - most + 1))
    arrays = ["halves", "n", "keys", "need"] if words_per_edit else ["halves", "n"]
    firsts = cut(keyed.groupBy("line").agg(F.min(place).alias("first"), *[F.first(c).alias(c) for c in arrays]))
    halves = firsts.select("line", F.explode(F.array_distinct("halves")).alias("half"))
    shared = halves.groupBy("half").agg(F.min("line").alias("x"), F.max("line").alias("y")).filter("x != y").select("half")
    go_on = halves.join(shared, "half").select("line")
    if words_per_edit:
        keys = firsts.select("line", "n", "need", F.explode("keys").alias("key"))
        # of a key only lines that have the next shorter or longer one within the edits; if not these, none is
        by_key = Window.partitionBy("key").orderBy("n", "line")
        keys = keys.withColumns({"less": F.lag("n").over(by_key), "more": F.lead("n").over(by_key)})
        shared = keys.filter(_within(words_per_edit)).groupBy("line", "need").count()
        go_on = go_on.unionByName(shared.filter("count >= need").select("line"))
    maybe = go_on.distinct().join(firsts, "line").select("line", "n", "first").repartitionByRange("first").sortWithinPartitions("first")
    maybe = cut(maybe.select(F.monotonically_increasing_id().alias("ord"), "line", "n", "first"))  # ord rises with first

    # the words of the lines that go on, read where they stand first
    wanted = maybe.groupBy(F.col("first.at").alias("at")).agg(F.collect_set("first.place").alias("places"))
    texts = F.transform(F.array(F.split(_plain(F.col("text")), "\n")), lambda x: F.transform("places", lambda i: F.get(x, i)))[0]
    chosen = rows.join(wanted, "at").select(F.explode(texts).alias("plain")).select("plain", F.xxhash64("plain").alias("line")).dropDuplicates(["line"])
    chosen = cut(chosen.join(maybe.drop("first"), "line").select("ord", "line", "n", "plain"))
    short = chosen.filter(n <= least) if words_per_edit else chosen
    short = short.select("ord", "line", words.alias("words"))

    ahead = Window.partitionBy("key").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    whole, less, swapped = (F.min(F.when(F.col("kind") == k, F.col("ord"))).over(ahead) for k in (0, 1, 2))
    partners = (
        _variants(short)
        .withColumn("earlier", F.when(F.col("kind") == 0, less).when(F.col("kind") == 1, whole).otherwise(swapped))
        .filter("earlier < ord")
        .groupBy("ord")
        .agg(F.min("earlier").alias("earlier"))
    )
    texts = short.select(F.col("ord").alias("earlier"), F.col("words").alias("words_b"))
    alike = cut(partners).join(short, "ord").join(texts, "earlier").filter(_one_edit(F.col("words"), F.col("words_b"))).select("line")
    if words_per_edit:
        alike = alike.unionByName(_many_edits(chosen.filter(n >= least), words_per_edit)).distinct()
    alike = cut(alike.withColumn("alike", F.lit(True)))
    kept = (
        firsts.join(alike, "line", "left")
        .filter(F.col("alike").isNull())
        .groupBy(F.col("first.at").alias("at"))
        .agg(F.collect_set("first.place").alias("kept"))
    )
    first_places = firsts.groupBy(F.col("first.at").alias("at")).agg(F.count("*").alias("n_first"))
    told = cut(first_places.join(kept, "at", "left"))
    split = F.split("text", "\n")
    stays = F.filter(
        F.transform(split, lambda line, i: F.struct(line.alias("line"), i.alias("i"))),
        lambda x: ~_has_word(x["line"]) | F.coalesce(F.array_contains("kept", x["i"]), F.lit(False)),
    )
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.filter(split, _has_word)))
    n_kept = F.when(F.col("kept").isNull(), 0).otherwise(F.size("kept"))
    told = rows.join(told, "at", "left").select("doc_id", "text", "kept", n_lines.alias("n_lines"), F.coalesce("n_first", F.lit(0)).alias("n_first"), n_kept.alias("n_kept"))
    text = F.when(F.col("n_kept") == F.col("n_lines"), F.col("text")).otherwise(F.array_join(F.transform(stays, lambda x: x["line"]), "\n"))
    return told.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        (F.col("n_lines") - F.col("n_first")).cast("long").alias("n_equal"),
        (F.col("n_first") - F.col("n_kept")).cast("long").alias("n_alike"),
        text.alias("text"),
    )
