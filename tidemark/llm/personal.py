"""Personal data by patterns and by bootstrapped contexts.

Base spans follow fixed patterns and are the seeds. The two words before a seed are a context; contexts that
several different seeds share become candidate extraction patterns. Candidates that stand before too many different
plain words to be plausible are found by counting one class of all words, and dropped; every occurrence of the others
is found and counted, and one that mostly stands before seeds is plausible. The graph of plausible patterns and the values they extract is scored in turns: a pattern by the mean belief in its values, a value by
the patterns that extract it. Values believed in become spans of the pattern's kind. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import spans
from tidemark.llm.common import pick, store

# The base patterns. Possessive repeats and the tests before a run give the same matches and keep
# long runs linear: all starts within a run succeed or fail together.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"
CARD = r"[0-9](?:[ -]?[0-9]){13,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

# Different seed values that make a context a candidate.
SUPPORT = 3
# Share of a pattern's different values that must be seeds, and belief from which a value is a span.
PLAUSIBLE = 0.3
BELIEVED = 0.6
TURNS = 3
# Words are dealt to so many classes by hash; those of one class that follow a context are a lower bound of all that do.
CLASSES = 16
# Contexts that are broadcast, some 5 MB, and looked up by hash beforehand; more are joined by shuffling. The table of
# hashes has this many bits for each.
BROADCAST = 50_000
PLACES = 16
# Code points before a span in which its context is looked for at first; if they hold no two whole words, more are.
REACH = (200, 4_000, 2**30)
SEPARATOR = "[ \n\t\r\u000b\f]"
EDGES = ".,;:!?()[]{}<>\"'"
# A number behind a context, of one or more words of digits, brackets and separators on one line: an address or a phone
# as the base patterns take it, else as many words as there are. Numbers have 19 digits at most, so 40 words are enough.
PIECE = r"[0-9()-]++(?:\.[0-9()-]++)*+"
OPEN, CLOSE = r"^[\"'<\[{,;:!?.]*", r"(?=[.,;:!?\"'<>\[\]{})]*(?:\s|$))"
RUN = rf"{OPEN}((?<![0-9])[0-9]++(?:\.[0-9]++){{3}}{CLOSE}|{PHONE}{CLOSE}|\+?(?=[^\s]*[0-9]){PIECE}(?: +{PIECE})*(?<=[0-9)]){CLOSE})"
NUMBER_WORDS = 40


def luhn(number: Column) -> Column:
    """The check-digit rule, from the right."""
    places = F.transform(F.split(F.reverse(number), ""), lambda d: d.cast("int"))

    def worth(d: Column, i: Column) -> Column:
        double = d * 2
        return F.when(i % 2 == 0, d).when(double > 9, double - 9).otherwise(double)

    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def base(text: Column) -> dict[str, Column]:
    """Spans of each kind."""
    count = lambda s: F.length(spans.digits(s["value"]))
    some_digit = text.rlike("[0-9]")
    return {
        "email": spans.found(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": spans.found(text, IP, some_digit & F.contains(text, F.lit(".")), lambda s: s["value"].rlike(IP_PARTS)),
        "card": spans.found(text, CARD, text.rlike("[0-9](?:[ -]?[0-9]){13}"), lambda s: (count(s) <= 19) & luhn(spans.digits(s["value"]))),
        "phone": spans.found(text, PHONE, F.contains(text, F.lit("+")), lambda s: count(s).between(10, 15)),
    }


def words(text: Column) -> Column:
    """The pieces between single white-space characters, so that places can be added up."""
    return F.split(text, SEPARATOR, -1)


def seeds(first: DataFrame) -> DataFrame:
    """(row, kind, value, context) of the base spans; the context is the two words before."""

    def one(kind: str) -> Column:
        def described(s: Column) -> Column:
            def within(reach: int) -> Column:
                begin = F.greatest(s["start"] - reach, F.lit(0))
                before = F.split(F.substring(F.col("text"), begin + 1, s["start"] - begin), SEPARATOR, -1)
                n = F.size(before)
                # The first piece is a whole word only where the text begins.
                context = F.concat_ws(" ", F.get(before, n - 3), F.get(before, n - 2))
                return F.when((n > 3) | ((n > 2) & (begin == 0)), F.lower(context))

            context = F.coalesce(*map(within, REACH))
            return F.struct(F.lit(kind).alias("kind"), F.lower(s["value"]).alias("value"), context.alias("context"))

        return F.transform(F.col(kind), described)

    each = first.where(F.size(F.concat(*KINDS)) > 0).select("row", F.explode(F.concat(*map(one, KINDS))).alias("s"))
    return each.select("row", "s.*").where("context is not null and trim(context) <> ''")


def candidates(found: DataFrame) -> DataFrame:
    """(context, kind) with ``SUPPORT`` different seeds or more; a context is a pattern of each such kind."""
    values = found.groupBy("context", "kind", "value").agg(F.count("*").alias("times"))
    counted = values.groupBy("context", "kind").agg(F.count("*").alias("different"))
    return counted.where(F.col("different") >= SUPPORT).select("context", "kind")


def heads(found: DataFrame) -> DataFrame:
    """(context, kind, value) of the seeds, the value as ``occurrences`` has it."""
    return found.select("context", "kind", F.lower(trimmed(F.col("value"))).alias("value")).distinct()


def among(places: DataFrame, known: DataFrame) -> DataFrame:
    """The places whose context is known; the contexts are broadcast up to ``BROADCAST`` of them."""
    return places.join(F.broadcast(known) if known.count() <= BROADCAST else known, "context", "left_semi")


def place_of(first: Column, second: Column, size: int) -> Column:
    """The place of a context, given its words, among ``size``, a power of two."""
    return F.xxhash64(first, second).bitwiseAND(F.lit(size - 1))


def behind(known: DataFrame) -> Column:
    """Numbers of the words of ``text`` that may stand behind a known context: a hash of the two words before is one of
    a known context's. Beyond ``BROADCAST`` contexts all words may."""
    n = known.count()
    if n > BROADCAST:
        last = F.size(words(F.col("text"))) - 1
        return F.when(last >= 2, F.sequence(F.lit(2), last)).otherwise(F.array().cast("array<int>"))
    size = 1 << max(10, (PLACES * n).bit_length())
    both = F.transform(F.split("context", " ", -1), lambda w: F.xxhash64(w))
    bits = [0] * (size // 64)
    for r in known.select(place_of(F.get(both, 0), F.get(both, 1), size).alias("at")).distinct().collect():
        bits[r["at"] // 64] |= 1 << r["at"] % 64
    signed = (b - (b >> 63 << 64) for b in bits)
    # A constant that is parsed once, when the query is planned.
    table = F.split(F.lit(",".join(map(str, signed))), ",").cast("array<bigint>")
    hashes = F.transform(words(F.lower("text")), lambda w: F.xxhash64(w))

    def is_known(place: Column) -> Column:
        return F.getbit(F.get(table, F.shiftright(place, 6)), place.bitwiseAND(63).cast("int")) == 1

    def found(h: Column) -> Column:
        places = F.transform(h, lambda x, i: place_of(F.get(h, i - 1), x, size))
        marked = F.transform(places, lambda place, i: F.when(is_known(place), i + 1))
        return F.filter(marked, lambda i: i.isNotNull() & (i >= 2) & (i < F.size(h)))

    return spans.bound(hashes, found)


def context_at(w: Column, i: Column) -> Column:
    return F.lower(F.concat_ws(" ", F.get(w, i - 2), F.get(w, i - 1)))


def promising(texts: DataFrame, known: DataFrame, held: DataFrame) -> DataFrame:
    """The candidates that may be plausible.

    Words without a digit or ``@`` are no seeds. The different ones of a class that follow a context are at most its
    values without seeds; if the seeds are too small a share beside them alone, the context is not plausible. What
    is left has, by its number of seeds, a bounded number of values to be expected, however frequent it is.
    """
    contexts = store(known.select("context").distinct(), "contexts")

    def plain(x: Column) -> Column:
        value = lambda i: F.lower(F.btrim(F.get(x["w"], i), F.lit(EDGES)))
        every = F.transform(x["at"], lambda i: F.struct(context_at(x["w"], i).alias("context"), value(i).alias("v")))
        return F.filter(every, lambda p: ~p["v"].rlike("[0-9@]") & (p["v"] != "") & (F.pmod(F.xxhash64(p["v"]), F.lit(CLASSES)) == 0))

    both = F.struct(words(F.col("text")).alias("w"), behind(contexts).alias("at"))
    each = texts.select(F.explode(spans.bound(both, plain)).alias("p")).select("p.context", F.xxhash64("p.v").alias("v"))
    found = among(each, contexts).distinct().groupBy("context").agg(F.count("*").alias("others"))
    seeds_of = held.groupBy("context", "kind").agg(F.count("*").alias("own"))
    joined = known.join(seeds_of, ["context", "kind"]).join(found, "context", "left")
    enough = F.col("own") >= PLAUSIBLE * (F.col("own") + F.coalesce("others", F.lit(0)))
    return joined.where(enough).select("context", "kind")


def occurrences(texts: DataFrame, known: DataFrame) -> DataFrame:
    """(row, at, context, token, value) for every place of a known context; ``at`` is the number of the word."""
    contexts = store(known.select("context").distinct(), "contexts")
    # The words with the white space behind them, for values of several words.
    every = F.struct(
        words(F.col("text")).alias("w"), F.split("text", f"(?<={SEPARATOR})", -1).alias("whole"), behind(contexts).alias("at")
    )

    def one(x: Column, i: Column) -> Column:
        word = F.get(x["w"], i)
        last = F.least(i + NUMBER_WORDS, F.size(x["whole"])) - 1
        run = F.regexp_extract(F.array_join(spans.part(x["whole"], i, last), ""), RUN, 0)
        token = F.when(word.rlike("^[^A-Za-z]*[0-9]"), F.coalesce(F.nullif(run, F.lit("")), word)).otherwise(word)
        return F.struct(i.alias("at"), context_at(x["w"], i).alias("context"), token.alias("token"))

    each = texts.select("row", F.explode(spans.bound(every, lambda x: F.transform(x["at"], lambda i: one(x, i)))).alias("p"))
    flat = each.select("row", "p.at", "p.context", "p.token")
    return among(flat, contexts).withColumn("value", F.lower(trimmed(F.col("token")))).where("value <> ''")


def trimmed(token: Column) -> Column:
    """Without the marks around it; brackets around the first digits of a longer number stay."""
    number = F.ltrim(F.rtrim(token, F.lit(EDGES)), F.lit(EDGES.replace("(", "")))
    return F.when(number.rlike(r"^\([0-9]+\).*[0-9]$"), number).otherwise(F.btrim(token, F.lit(EDGES)))


def score(edges: DataFrame) -> DataFrame:
    """(kind, value, belief) of the values that are not seeds, from (context, kind, value, seed), in ``TURNS`` turns.

    Seeds are believed in. A pattern is worth the mean belief in its different values; a value is believed in as
    much as its patterns are worth together (one minus the product of their doubts).
    """
    belief = edges.select("kind", "value", F.col("seed").cast("double").alias("belief")).groupBy("kind", "value").agg(F.max("belief").alias("belief"))
    for _ in range(TURNS):
        worth = edges.join(store(belief, "belief"), ["kind", "value"]).groupBy("context", "kind").agg(F.avg("belief").alias("worth"))
        doubt = edges.join(store(worth, "worth"), ["context", "kind"]).groupBy("kind", "value").agg(
            F.max("seed").alias("seed"), F.sum(F.log(F.greatest(1 - F.col("worth"), F.lit(1e-9)))).alias("doubt")
        )
        belief = doubt.select("kind", "value", F.when(F.col("seed"), 1.0).otherwise(1 - F.exp("doubt")).alias("belief"), "seed")
    return belief.where("not seed").select("kind", "value", "belief")


def extracted(places: DataFrame, known: DataFrame, held: DataFrame) -> DataFrame:
    """(context, kind, value, seed) of the different values behind each pattern; a seed of one kind only is no value of
    the context's other kinds."""
    values = places.select("context", "value").distinct().join(known, "context")
    kinds = held.groupBy("context", "value").agg(F.collect_set("kind").alias("kinds"))
    marked = values.join(store(kinds, "heads"), ["context", "value"], "left")
    marked = marked.withColumn("seed", F.coalesce(F.array_contains("kinds", F.col("kind")), F.lit(False)))
    return marked.where("seed or kinds is null").select("context", "kind", "value", "seed")


def placed(texts: DataFrame, places: DataFrame) -> DataFrame:
    """(row, kind, start, end) of tokens at numbered words, from (row, at, kind, token).

    The words between one place and the next give the distance; distances add up along the row, so every word is
    looked at once, however many places a text has.
    """
    hits = places.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("at", "kind", "token"))).alias("hits"))
    # A text in several rows is one text here.
    held = texts.join(store(hits, "hits"), "row").dropDuplicates(["row"])

    def distances(w: Column) -> Column:
        def distance(h: Column, i: Column) -> Column:
            before = F.when(i == 0, 0).otherwise(F.get(F.col("hits"), i - 1)["at"])
            between = spans.part(w, before, h["at"] - 1)
            length = F.when(h["at"] == before, 0).otherwise(F.length(F.array_join(between, " ")) + 1)
            return F.struct(h["at"].alias("at"), h["kind"].alias("kind"), h["token"].alias("token"), length.alias("step"))

        return F.transform("hits", distance)

    each = held.select("row", F.explode(spans.bound(words(F.col("text")), distances)).alias("h")).select("row", "h.*")
    along = Window.partitionBy("row").orderBy("at", "kind", "token").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = trimmed(F.col("token"))
    start = F.sum("step").over(along) + F.position(value, F.col("token")) - 1
    return each.select("row", "kind", start.cast("int").alias("start"), (start + F.length(value)).cast("int").alias("end"))


def discovered(texts: DataFrame, first: DataFrame) -> DataFrame:
    """(row, kind, start, end) of the values that contexts reveal."""
    found = store(seeds(first), "seeds")
    held = store(heads(found), "head-values")
    known = store(promising(texts, store(candidates(found), "candidates"), held), "promising")
    places = store(occurrences(texts, known), "occurrences")
    marked = store(extracted(places, known, held), "extracted")
    share = marked.groupBy("context", "kind").agg(F.avg(F.col("seed").cast("double")).alias("share"))
    plausible = store(share.where(F.col("share") >= PLAUSIBLE).select("context", "kind"), "plausible")
    edges = store(marked.join(plausible, ["context", "kind"]), "edges")
    believed = score(edges).where(F.col("belief") >= BELIEVED)
    # A value has one kind: a number is no email and a word most likely one; then the kind that is believed most.
    number = F.col("value").rlike("^[0-9() .+-]+$")
    fits = number == (F.col("kind") != "email")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    best = believed.groupBy("value").agg(F.max_by("kind", F.struct(fits.alias("fits"), "belief", -order)).alias("kind"))
    mine = places.join(plausible, "context").join(store(best, "believed"), ["kind", "value"])
    return placed(texts, mine.select("row", "at", "kind", "token").distinct())


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` and ``base_sha256`` of the base spans, ``spans``
    of all, ``n_found`` (spans that contexts add).

    A null or empty text has no span; a text repeated in several rows counts its values once; repeated rows come
    out repeated; an empty table gives an empty table; other columns are ignored.
    """
    docs = pick(df, doc_id=doc_id, text=text)
    body = F.coalesce(F.col("text"), F.lit(""))
    # Rows are numbered by their content, so that later passes over the same table find them again.
    numbered = docs.select(F.col("doc_id").cast("bigint"), body.alias("text"), F.xxhash64("doc_id", body).alias("row"))
    spanned = numbered.select("doc_id", "row", "text", *[c.alias(k) for k, c in base(F.col("text")).items()])
    kept = F.when(F.size(F.concat(*KINDS)) > 0, F.col("text"))
    first = store(spanned.withColumn("text", kept), "personal")
    more = discovered(numbered.select("row", "text").where("text <> ''"), first)
    listed = store(more.distinct().groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more")), "found")
    joined = first.join(listed, "row", "left")
    everywhere = F.concat(*KINDS)

    def added(kind: str) -> Column:
        mine = F.filter(F.col("more"), lambda s: (s["kind"] == kind) & ~F.exists(everywhere, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
        typed = F.transform(mine, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("").alias("value")))
        return F.coalesce(typed.cast(spans.KIND), F.array().cast(spans.KIND))

    done = joined.withColumns({f"more_{k}": added(k) for k in KINDS})
    base_kinds = {k: F.col(k) for k in KINDS}
    return done.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(spans.joined(base_kinds), 256).alias("base_sha256"),
        spans.joined({k: F.concat(k, f"more_{k}") for k in KINDS}).alias("spans"),
        F.size(F.concat(*[f"more_{k}" for k in KINDS])).cast("bigint").alias("n_found"),
    )
