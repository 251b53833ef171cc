"""Line dedup by an exact set-similarity join over line tokens; DataFrame operations only.

A line is the set of its words, as hashes. The range of hashes is cut into more
parts than two similar lines of that size can differ in words, so some parts
hold the same words in both: a line's signatures are the hashes of its parts.
Lines meet on a signature, after each line has left out its most common ones,
as many as the parts to spare allow; sizes rule out most other meetings inside
the join; the rest is verified with the whole sets. A line that is similar to
one further ahead in the corpus (document id, then line number; texts of one id
in the order of their hashes) is removed, whether or not that one is removed
too. Lines are first tried with two leaders of their common signatures, so that
a family of near copies does not meet pair by pair.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import materialize, settled, small, told_apart
from lakemart.session import scratch_path, scratch_scope, write_scratch

#: Jaccard similarity, in percent, from which a line counts as the same.
PERCENT = 85
#: Lines that share a signature from which on they are first tried with its leaders; it never changes a result.
LED = 32
#: Bits of a word's hash.
BITS = 62
#: Sizes of one class are at most so much apart, in percent, or what two similar lines may be; it never changes a result.
CLASS = 150
#: Up to so many parts, signatures are of pairs of parts; it never changes a result.
PAIRED = 4
#: Up to so many parts, their signatures are written out; it never changes a result.
WRITTEN = 26
#: The classes of sizes below are looked up; it never changes a result.
LISTED = 512
#: Sets of so many words on have 128 bits of parity instead of 64; it never changes a result.
WIDE = 64
#: Sizes of sets end here.
MOST_WORDS = 1 << 31


def _plain(text: Column) -> Column:
    """Every white space but the line feed a space."""
    plain, odd = text, F.lit(False)
    for c in "\t\r\x0b\x0c":
        plain, odd = F.replace(plain, F.lit(c), F.lit(" ")), odd | F.contains(text, F.lit(c))
    return F.when(odd, plain).otherwise(text)


def _lines(texts: DataFrame) -> DataFrame:
    """Lines that have words."""
    lower = texts.select("_key", "_tie", F.lower("_text").alias("_text"))
    plain = lower.select("_key", "_tie", _plain(F.col("_text")).alias("_text"))
    return plain.select("_key", "_tie", F.posexplode(F.split("_text", "\n")).alias("_pos", "_line")).where(F.trim("_line") != "")


def line_keys(line: Column) -> Column:
    """The distinct words of a line as sorted, even hashes."""
    cut = lambda h: h.bitwiseAND(F.lit((1 << BITS) - 2).cast("long"))
    words = F.transform(F.split(line, " "), lambda w: cut(F.xxhash64(w)))
    return F.sort_array(F.array_distinct(F.array_remove(words, cut(F.xxhash64(F.lit(""))))))


def size_classes(percent: int) -> list[tuple[int, int, int]]:
    """``(least size, parts, signatures that similar sets share)`` of each class of set sizes.

    Similar sets of sizes n and m differ in at most (n + m)(100 - percent)/(100 + percent) words. A class has that many
    parts for its largest sets, and some to spare: of two similar sets at least the parts to spare are equal. A pair meets
    in the class of its larger set; the smaller one is of that class or of the one before. With up to ``PAIRED`` parts,
    2 of them to spare, a signature is of two parts: a single one would hold few words.
    """
    out = []
    least = -(-(100 + percent) // (2 * (100 - percent))) if percent < 100 else MOST_WORDS
    while least < MOST_WORDS:
        after = max(-(-least * CLASS // 100), -(-least * 100 // percent))
        differ = 2 * (after - 1) * (100 - percent) // (100 + percent)
        spare = 2 + differ // 6
        out.append((least, differ + spare, 1 if differ + spare <= PAIRED else spare))
        least = after
    return out


def _class(n: Column, classes: list[tuple[int, int, int]]) -> Column:
    """From 1 on; 0 for sizes whose similar sets are equal."""
    starts = [c[0] for c in classes]
    listed = F.array(*[F.lit(bisect_right(starts, size)) for size in range(LISTED)])
    rest = F.size(F.filter(F.array(*map(F.lit, starts), F.lit(MOST_WORDS - 1)), lambda least: least <= n))
    return F.when(n < LISTED, F.get(listed, n.cast("int"))).otherwise(rest)


def _of_class(number: Column, classes: list[tuple[int, int, int]], at: int) -> Column:
    return F.element_at(F.array(F.lit(0), *[F.lit(min(c[at], MOST_WORDS - 1)) for c in classes]), number + 1)


def with_signatures(sets: DataFrame, percent: int) -> DataFrame:
    """``_keys`` replaced by ``signatures`` in the set's own class and, if a similar set may be of it, the next.

    The last bit tells the two classes apart. A signature hashes the class, the number of the part (or pair of parts) and the words in it.
    """
    classes = size_classes(percent)
    rest = [c for c in sets.columns if c != "_keys"]

    def cut(parts: Column, step: Column) -> Column:
        """The sorted words, with a mark before each part and after the last; words are even, marks end in 1.

        Words after the last mark, which division leaves, are in no part.
        """
        return F.when(parts > 0, F.sort_array(F.concat("_keys", F.sequence(F.lit(1).cast("long"), parts * step + 1, step))))

    def places(parts: Column, step: Column, told: Column) -> Column:
        """Of the marks of few parts."""
        found = F.transform(F.sequence(F.lit(0), parts), lambda i: F.array_position(told, step * i + 1).cast("int"))
        return F.when((parts > 0) & (parts <= WRITTEN), found)

    def signed(number: Column, parts: Column, told: Column, at: Column) -> Column:
        odd = number.bitwiseAND(F.lit(1)).cast("long")
        last = lambda *of: F.shiftleft(F.xxhash64(number, *of), 1).bitwiseOR(odd)
        words = lambda i: F.slice(told, F.get(at, F.lit(i)) + 1, F.get(at, F.lit(i + 1)) - F.get(at, F.lit(i)) - 1)
        # Written out for few parts: compiled, and a lambda is not.
        pairs = F.array(*[F.when(parts > j, last(F.lit(i), words(i), F.lit(j), words(j))) for j in range(PAIRED) for i in range(j)])
        singles = F.array(*[F.when(parts > i, last(F.lit(i), words(i))) for i in range(WRITTEN)])
        # Else as text cut at "1 ": each piece holds a part and, the same in all sets, the digits of the next mark.
        pieces = F.slice(F.split(F.array_join(told.cast("array<string>"), " "), "1 "), F.lit(2), parts)
        few = F.when(parts <= PAIRED, F.slice(pairs, F.lit(1), (parts * (parts - 1) / 2).cast("int"))).otherwise(F.slice(singles, F.lit(1), parts))
        made = F.when(parts <= WRITTEN, few).otherwise(F.transform(pieces, lambda t, i: last(i, t)))
        return F.when(parts > 0, made).otherwise(F.array().cast("array<bigint>"))

    own = _class(F.col("n"), classes)
    reach = _class(F.floor(F.col("n").cast("long") * 100 / percent), classes)
    made = sets.select("*", own.alias("_c0"), reach.alias("_c1")).withColumn("_c1", F.when(F.col("_c1") > F.col("_c0"), F.col("_c1")).otherwise(0))
    made = made.select("*", *[_of_class(F.col(f"_c{i}"), classes, 1).alias(f"_parts{i}") for i in (0, 1)])
    # Steps end in 0.
    step = lambda parts: F.call_function("div", F.lit(1 << BITS).cast("long"), F.greatest(parts, F.lit(1)).cast("long") * 10) * 10
    made = made.select("*", *[step(F.col(f"_parts{i}")).alias(f"_step{i}") for i in (0, 1)])
    made = made.select("*", *[cut(F.col(f"_parts{i}"), F.col(f"_step{i}")).alias(f"_told{i}") for i in (0, 1)])
    made = made.select("*", *[places(*[F.col(f"_{c}{i}") for c in ("parts", "step", "told")]).alias(f"_at{i}") for i in (0, 1)])
    both = [signed(*[F.col(f"_{c}{i}") for c in ("c", "parts", "told", "at")]) for i in (0, 1)]
    return made.select(*rest, F.concat(*both).alias("signatures"))


def _sketched(keyed: DataFrame) -> DataFrame:
    """With ``p0`` and ``p1``: parities of the words of each of 64 kinds. Two sets differ in at least as many words as bits.

    From ``WIDE`` words on, ``p1`` has half of the words; of fewer, ``p0`` has all.
    """
    flipped = lambda bits, h, unit: bits.bitwiseXOR(F.call_function("shiftleft", unit, F.shiftright(h, 31).cast("int")))
    one, nil = F.lit(1).cast("long"), F.lit(0).cast("long")
    every = F.aggregate("_keys", nil, lambda bits, h: flipped(bits, h, one))
    half = F.aggregate("_keys", nil, lambda bits, h: flipped(bits, h, F.shiftright(h, 40).bitwiseAND(one)))
    made = keyed.select("*", every.alias("_every"), F.when(F.col("n") >= WIDE, half).otherwise(nil).alias("p1"))
    return made.withColumn("p0", F.col("_every").bitwiseXOR(F.col("p1"))).drop("_every")


def _near(a: str, b: str, percent: int) -> Column:
    """Whether the sizes and sketches of two different sets allow them to be similar; ``a`` and ``b`` begin their columns' names."""
    n, m = (F.col(f"{x}n").cast("long") for x in (a, b))
    x, y = (F.col(f"{a}p{i}").bitwiseXOR(F.col(f"{b}p{i}")) for i in (0, 1))
    apart = F.when((n >= WIDE) & (m >= WIDE), F.bit_count(x) + F.bit_count(y)).otherwise(F.bit_count(x.bitwiseXOR(y)))
    return (n * 100 >= m * percent) & (m * 100 >= n * percent) & (apart * (100 + percent) <= (n + m) * (100 - percent))


# Turn the order of set numbers, so that every round has other leaders.
_TURNS = (0, 0x5555555555555555, 0x3333333333333333)


def _leaders() -> list[Column]:
    """Two sets of a signature for each round, by least and greatest number: plain partial aggregates."""
    out = []
    for turn in _TURNS:
        mask = F.lit(turn).cast("long")
        out += [f(F.col("s1").bitwiseXOR(mask)).bitwiseXOR(mask) for f in (F.min, F.max)]
    return [c.alias(f"l{i}") for i, c in enumerate(out)]


def repeated_lines(docs: DataFrame, key: str, text: str, percent: int = PERCENT) -> DataFrame:
    """``(_key, _tie, _pos)`` of every line that an earlier line is similar to; lines without words are none.

    ``_tie`` as in :func:`told_apart`: rows of one key and text are one document, other texts of the key are others.
    """
    return _repeated(told_apart(docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")))[0], percent)


def _signed_sets(texts: DataFrame, percent: int, sets_path: str, lines_path: str) -> tuple[DataFrame, DataFrame]:
    """Written: every set once with its first line and signatures; every line with words and the two numbers of its set."""
    keyed = _lines(texts).select("_key", "_tie", "_pos", line_keys(F.col("_line")).alias("_keys"))
    keyed = keyed.select("*", F.size("_keys").alias("n"), F.xxhash64("_keys").alias("s1"), F.xxhash64(F.lit(1), "_keys").alias("s2"))
    whole = materialize(with_signatures(_sketched(keyed), percent), "line-signed")
    first = F.min(F.struct("_key", "_tie", "_pos")).alias("first")
    same = [F.first(c).alias(c) for c in ("n", "p0", "p1", "signatures")]
    signed = write_scratch(whole.groupBy("s1", "s2").agg(first, F.count("*").alias("lines"), *same), sets_path)
    return signed, write_scratch(whole.select("_key", "_tie", "_pos", "s1", "s2"), lines_path)


def _line_sets(texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written: every line with words and the two numbers of its set; every set once, with its first line; the postings.

    A posting is a row of a set and a signature that it shares with others; each set's most common ones are left out. Two
    similar sets share a known number of signatures of a class. Each leaves out one less than that, the last in one order
    for all: the first one that they share stays in both.
    """
    spark = texts.sparkSession
    lines_path, sets_path, posted_path = (scratch_path(spark, f"line-{x}") for x in ("sets", "distinct", "postings"))
    with scratch_scope(spark):
        wide_path = scratch_path(spark, "line-wide")
        with scratch_scope(spark):
            signed, lines = _signed_sets(texts, percent, wide_path, lines_path)
        each = signed.select("s1", F.explode("signatures").alias("sig"))
        shared = materialize(each.groupBy("sig").agg(F.count("*").alias("c")).where("c > 1"), "line-shared")
        met = each.join(small(shared).hint("shuffle_hash"), "sig")
        classes = size_classes(percent)
        odd = F.col("sig").bitwiseAND(F.lit(1).cast("long")).cast("int")
        own = _class(F.col("n"), classes)
        number = F.when(F.pmod(own, F.lit(2)) == odd, own).otherwise(own + 1)
        told = signed.drop("lines", "signatures").join(met, "s1").withColumn("_spare", _of_class(number, classes, 2)).withColumn("_odd", odd)
        order = Window.partitionBy("s1", "s2", "_odd").orderBy(F.desc("c"), F.desc("sig"))
        left = told.withColumn("_at", F.row_number().over(order)).where("_at >= _spare")
        posted = write_scratch(left.select("sig", "s1", "first", "n", "p0", "p1"), posted_path)
        sets = write_scratch(signed.drop("signatures"), sets_path)
    return lines, sets, posted


def _repeated(rows: DataFrame, percent: int) -> DataFrame:
    spark = rows.sparkSession
    texts = rows.where("_key IS NOT NULL AND _text IS NOT NULL")
    lines, sets, posted = _line_sets(texts, percent)

    def similar(pairs: DataFrame) -> DataFrame:
        """The later line of each pair ``(late, early)`` whose whole sets are similar."""
        pairs = materialize(pairs, "line-pairs")
        n = pairs.count()
        firsts = pairs.select(F.col("late").alias("first")).unionByName(pairs.select(F.col("early").alias("first"))).distinct()
        places = materialize(firsts.select("first._key", "first._tie", "first._pos", "first"), "line-wanted")
        owners = materialize(places.select("_key", "_tie").distinct(), "line-owners")
        found = _lines(texts.join(small(owners), ["_key", "_tie"], "left_semi")).join(small(places), ["_key", "_tie", "_pos"])
        whole = materialize(found.select("first", line_keys(F.col("_line")).alias("_keys")), "line-keys")
        late = whole.join(small(pairs, n), F.col("first") == F.col("late")).select("early", "late", F.col("_keys").alias("x"))
        early = whole.join(small(pairs.select(F.col("early").alias("first")).distinct(), n), "first").select(F.col("first").alias("early"), F.col("_keys").alias("y"))
        sides = late.join(early, "early")
        both = F.size(F.array_intersect("x", "y"))
        sound = sides.where(both * 100 >= (F.size("x") + F.size("y") - both) * percent)
        return sound.select(F.col("late").alias("first")).distinct()

    def after_leaders() -> DataFrame:
        """Lines that are similar to the likeliest of the leaders of their signatures, by the sketches.

        In a family of copies that is most of the lines that have an earlier match, however many lines it has.
        """
        crowds = materialize(posted.groupBy("sig").agg(F.count("*").alias("c")).where(F.col("c") >= LED).select("sig"), "line-crowds")
        crowded = materialize(posted.join(small(crowds), "sig"), "line-crowded")
        leaders = crowded.groupBy("sig").agg(*_leaders()).select("sig", F.array_distinct(F.array(*[f"l{i}" for i in range(2 * len(_TURNS))])).alias("leads"))
        leaders = materialize(leaders, "line-leaders")
        heads = leaders.select(F.explode("leads").alias("s1")).distinct().join(sets, "s1").select(F.col("s1").alias("lead"), *[F.col(c).alias(f"_{c}") for c in ("first", "n", "p0", "p1")])
        heads = materialize(heads, "line-heads")
        led = crowded.join(small(leaders), "sig").select("s1", "first", "n", "p0", "p1", F.explode("leads").alias("lead")).where("lead <> s1").distinct()
        led = led.join(small(heads), "lead").where(_near("", "_", percent) & (F.col("_first") < F.col("first")))
        apart = F.bit_count(F.col("p0").bitwiseXOR(F.col("_p0"))) + F.bit_count(F.col("p1").bitwiseXOR(F.col("_p1")))
        best = led.groupBy(F.col("first").alias("late")).agg(F.min(F.struct(apart.alias("apart"), F.col("_first").alias("early"))).alias("_best"))
        return similar(best.select("late", "_best.early"))

    gone = settled(spark, "line-gone", after_leaders)

    # Then those still without a match, with every earlier line of their signatures.
    a, b = posted.join(small(gone), "first", "left_anti").alias("a"), posted.alias("b")
    met = a.join(b, (F.col("a.sig") == F.col("b.sig")) & (F.col("b.first") < F.col("a.first")) & _near("a.", "b.", percent))
    met = met.select(F.col("a.first").alias("late"), F.col("b.first").alias("early")).distinct()
    more = settled(spark, "line-gone", lambda: similar(met))
    # The first line of a set goes for a similar one, the others for the first.
    again = lines.join(small(sets.where("lines > 1").select("s1", "s2", "first")), ["s1", "s2"])
    again = again.where(F.col("first") < F.struct("_key", "_tie", "_pos")).select("_key", "_tie", "_pos")
    return gone.unionByName(more).select("first._key", "first._tie", "first._pos").unionByName(again)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with its text less repeated lines, plus ``n_lines``, ``n_removed`` and ``all_removed``.

    ``all_removed``: every line with words went. A null text stays null (0
    lines), an empty one is one line without words, which always stays. Rows of
    one key and text are one document: repeated rows lose the same lines. Other
    texts of a key are documents of their own, in the order of their hashes. A
    row with a null key stays as it is and is matched with none. Clashing column
    names: existing columns of the three added names are replaced.
    """
    added = ["n_lines", "n_removed", "all_removed"]
    names = docs.drop(*added).columns
    own = {c: {key: "_key", text: "_text"}.get(c, f"_c{i}") for i, c in enumerate(names)}
    rows, _ = told_apart(docs.select(*[F.col(f"`{c}`").alias(a) for c, a in own.items()]))
    doc = [F.col("_key").alias("_doc"), F.col("_tie").alias("_doc_tie")]
    per_doc = settled(
        docs.sparkSession, "line-removed", lambda: _repeated(rows.select("_key", "_text", "_tie"), percent).groupBy(*doc).agg(F.collect_set("_pos").alias("_gone"))
    )
    joined = rows.join(small(per_doc), (F.col("_key") == F.col("_doc")) & (F.col("_tie") == F.col("_doc_tie")), "left")
    lines = F.split("_text", "\n")
    left = F.filter(lines, lambda line, i: ~F.array_contains("_gone", i))
    kept = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(left, "\n"))
    n_removed = F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone"))
    breaks = F.octet_length("_text") - F.octet_length(F.replace(F.col("_text"), F.lit("\n"), F.lit("")))
    made = joined.withColumn("n_lines", F.coalesce(breaks + 1, F.lit(0)).cast("long"))
    made = made.withColumn("n_removed", n_removed.cast("long")).withColumn("_kept", kept)
    made = made.withColumn("all_removed", (F.col("n_removed") > 0) & (F.length(F.trim(F.translate("_kept", "\n\t\r\x0b\x0c", "     "))) == 0))
    return made.select(*[F.col("_kept" if c == text else a).alias(c) for c, a in own.items()], *added)
