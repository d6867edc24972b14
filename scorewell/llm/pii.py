"""Surrogates for personal data, with DataFrame functions only.

1. Detect.  One pattern finds mentions in a text: e-mail addresses, phone
   numbers, IPv4 addresses, card numbers, IBANs, social-security numbers,
   secrets (access keys, and values after ``token=`` and the like) and names
   after a title.  Its matches and the gaps between them add up to the text.
2. Identify.  A mention holds one entity (two for given and family name),
   whose canonical form drops what only formats it, so ``+1 (264) 555-1012``
   and ``+1 264 555 1012`` are one entity and get one surrogate.
3. Replace.  A surrogate is derived from a keyed SHA-256 of type, canonical
   form and attempt: each letter or digit becomes another of its class, a
   country code, key prefix or top-level domain stays, card numbers that
   pass the Luhn check pass it again, IPv4 octets stay in 1..254, names are
   made of syllables of the same script with an ending by gender.
4. Check collisions.  Two entities of a type may not share a surrogate, and
   no surrogate may be an entity that occurs.  The smaller canonical form
   keeps a contested surrogate, the others draw again with the next attempt.
5. Write back.  Each mention's surrogate takes the format of that mention; a
   full name known from a title is also replaced where the same text has it
   bare.  A bare name whose title stands in another text, and a family name
   on its own, are not detected.

Only texts with mentions are shuffled, once, by their SHA-256; entities are
aggregated to distinct rows before any join.

Edge cases: a null text stays null and an empty one empty, with no
entities; repeated rows are all rewritten; a text of any length is handled
whole; an empty table gives no rows; every other column passes unchanged,
also one that bears a name used here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import free_name, numbered, place, whole_rows
from scorewell.session import scratch_path

_EMAIL = r"(?<![\w\p{L}\p{N}.%+-])[\w\p{L}\p{N}.%+-]++@(?:[\p{L}\p{N}-]++\.)+\p{L}{2,24}"
_IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_PHONE = (r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
          r"|(?<![\w(])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
          r"|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])")
_CARD = r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])"
_IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
_KEY = r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)"
# In any case, with more of a name before (stays in the gap) or after: DB_PASSWORD, secretKey, TOKEN-2.
# Where the keyword goes on in small letters (secretary, tokenizer, tokenhash) the value must have a digit.
_GIVEN = r"\s{0,3}[=:]\s{0,3}[\"']?"
_VALUE = (r"(?=[apstAPST])(?i:api[_-]?key|secret|token|password|passwd|pwd)"
          r"(?:(?:s|[A-Z_\d-][\w-]*+)?" + _GIVEN + r"[A-Za-z0-9+/_-]{8,}"
          r"|[\w-]*+" + _GIVEN + r"(?=[A-Za-z+/_-]*+\d)[A-Za-z0-9+/_-]{8,})")
_TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин"),
           "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "госпожа")}
_TITLE = "(?:" + "|".join(t for ts in _TITLES.values() for t in ts) + r")\.? "
_NAME = r"(?<![\w-])" + _TITLE + r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?"

#: Bounds of a full name that stands without a title.
_BEFORE, _AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"

#: Every mention, the types tried in this order at each place.
MENTION = "|".join(f"(?:{p})" for p in (_EMAIL, _IP, _SSN, _PHONE, _IBAN, _KEY, _CARD, _VALUE, _NAME))

#: A text without any of these holds no mention.
_MAYBE = r"[@\d=:]|AKIA|ASIA|" + _TITLE


def _type(m: Column) -> Column:
    """Type of a mention, by its own form."""
    def whole(p: str) -> Column:
        return m.rlike(f"^(?:{p})$")
    return (F.when(m.contains("@"), "email").when(whole(_IP), "ip").when(whole(_SSN), "ssn")
            .when(whole(_PHONE), "phone").when(whole(_IBAN), "iban").when(whole(_KEY), "key")
            .when(whole(_CARD), "card").when(whole(_NAME), "name").otherwise("secret"))


def _prefix(kind: Column, m: Column) -> Column:
    """What stays at the front of a mention: key prefix, ``token=``, title."""
    return (F.when(kind == "key", F.substring(m, 1, 4))
            .when(kind == "secret", F.regexp_extract(
                m, r"(?s)^(.*?[=:]\s{0,3}[\"']?)[A-Za-z0-9+/_-]+$", 1))
            .when(kind == "name", F.regexp_extract(m, f"^({_TITLE})", 1))
            .when(kind == "iban", F.substring(m, 1, 2))
            .when(kind == "phone", F.regexp_extract(m, r"^(\+1(?!\d)|\+\d{2}(?=\d* )|\+\d{1,3}(?=[ .(-])|)", 1))
            .otherwise(F.lit("")))


def _entities(kind: Column, m: Column, body: Column) -> Column:
    """Entities of a mention in order: (type, canonical form)."""
    def one(t: Column, canon: Column) -> Column:
        return F.struct(t.alias("kind"), canon.alias("canon"))
    words = F.split(body, " ")
    male = m.rlike("^(?:" + "|".join(_TITLES["m"]) + r")\b")
    given = F.when(male, "given_m").otherwise("given_f")
    digits = F.regexp_replace(body, r"\D", "")
    return (F.when(kind == "email", F.array(one(kind, F.lower(body))))
            .when(kind.isin("phone", "card", "ssn"), F.array(one(kind, digits)))
            .when(kind == "iban", F.array(one(kind, F.replace(body, F.lit(" ")))))
            .when((kind == "name") & (F.size(words) > 1), F.array(
                one(given, F.get(words, F.lit(0))), one(F.lit("family"), F.get(words, F.lit(1)))))
            .when(kind == "name", F.array(one(F.lit("family"), body)))
            .otherwise(F.array(one(kind, body))))


def _draws(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """384 keyed bytes as hexadecimal text."""
    base = F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"))
    return F.concat(*[F.sha2(F.concat(base, F.lit(f"\x1f{i}")), 256) for i in range(12)])


def _byte(draws: Column, i: Column) -> Column:
    """Number 0..65535 for place ``i``; places repeat after 192."""
    return F.conv(F.substr(draws, F.pmod(i, F.lit(192)) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _shape(canon: Column, draws: Column) -> Column:
    """Each digit or letter becomes another of its class, the rest stays."""
    def swap(c: Column, i: Column) -> Column:
        n = _byte(draws, i)
        def pick(alphabet: str) -> Column:
            return F.substr(F.lit(alphabet), F.pmod(n, F.lit(len(alphabet))) + 1, F.lit(1))
        return (F.when(c.rlike("[0-9]"), pick("0123456789"))
                .when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz"))
                .when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
                .when(c.rlike(r"\p{IsCyrillic}"), pick("абвгдежзиклмнопрстуфхцчшэюя"))
                .when(c.rlike(r"\p{IsGreek}"), pick("αβγδεζηθικλμνξοπρστυφχψω"))
                .when(c.rlike(r"\p{L}"), pick("àáâäåçèéêëìíîïñòóôöùúûü")).otherwise(c))
    return F.array_join(F.transform(F.split(canon, ""), swap), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a text of digits; a multiple of ten is valid."""
    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * (1 + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0),
                       lambda a, b: a + b)


def _card(canon: Column, draws: Column) -> Column:
    """The issuer's first digit stays; a valid number gives a valid one."""
    body = F.concat(F.substring(canon, 1, 1),
                    F.substr(_shape(canon, draws), F.lit(2), F.length(canon) - 2))
    check = F.pmod(-luhn_sum(F.concat(body, F.lit("0"))), F.lit(10))
    last = F.when(luhn_sum(canon) % 10 == 0, check).otherwise(
        F.pmod(check + 1 + _byte(draws, F.lit(150)) % 9, F.lit(10)))
    return F.concat(body, last.cast("string"))


def _name(kind: Column, canon: Column, draws: Column, attempt: Column) -> Column:
    """Three or four syllables in the script of the name, an ending by gender;
    one syllable more with every fourth attempt, so the names never run out."""
    def word(consonants: str, vowels: str, ends: dict[str, str]) -> Column:
        def syllable(i: Column) -> Column:
            return F.concat(*[F.substr(F.lit(a), F.pmod(_byte(draws, i * 2 + j), F.lit(len(a))) + 1,
                                       F.lit(1)) for j, a in enumerate((consonants, vowels))])
        stem = F.array_join(F.transform(
            F.sequence(F.lit(0), 2 + _byte(draws, F.lit(100)) % 2 + F.floor(attempt / 4).cast("int")), syllable), "")
        end = F.when(kind == "given_f", ends["f"]).when(kind == "given_m", ends["m"]).otherwise(
            ends["x"])
        return F.initcap(F.concat(stem, end))
    return F.when(canon.rlike(r"\p{IsCyrillic}"), word("бвгдзклмнпрст", "аеиоу", {
        "f": "на", "m": "р", "x": "в"})).when(canon.rlike(r"\p{IsGreek}"), word(
            "βγδκλμνπρστφ", "αεηιου", {"f": "να", "m": "ρος", "x": "ς"})).otherwise(word(
                "bdfgklmnprstv", "aeiou", {"f": "na", "m": "n", "x": "r"}))


def _surrogate(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    draws = _draws(key, kind, canon, attempt)
    top = F.regexp_extract(canon, r"(\.[a-z]+)$", 1)
    email = F.concat(_shape(F.substr(canon, F.lit(1), F.length(canon) - F.length(top)), draws), top)
    ip = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (
        1 + F.pmod(_byte(draws, i), F.lit(254))).cast("string")), ".")
    return (F.when(kind == "email", email).when(kind == "ip", ip)
            .when(kind == "card", _card(canon, draws))
            .when(kind.isin("given_m", "given_f", "family"), _name(kind, canon, draws, attempt))
            .otherwise(_shape(canon, draws)))


def surrogate_map(entities: DataFrame, key: str, rounds: int = 64) -> DataFrame:
    """kind, canon, surrogate for distinct (kind, canon) rows; surrogates are
    distinct within a kind and are no entity of it.

    Each round draws for the entities that have none yet; results so far stand
    in the shared scratch folder.  Raises if ``rounds`` are not enough.
    """
    spark = entities.sparkSession
    root = scratch_path(spark, "surrogates")
    entities.write.parquet(f"{root}/entities")
    real = spark.read.parquet(f"{root}/entities")
    pending, done = real, None
    for attempt in range(rounds):
        drawn = pending.withColumn("surrogate", _surrogate(
            key, F.col("kind"), F.col("canon"), F.lit(attempt)))
        free = drawn.join(real.select("kind", F.col("canon").alias("surrogate")),
                          ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        # the smallest canonical form keeps a contested surrogate
        free.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon")).write.parquet(
            f"{root}/done/{attempt:03d}")
        done = spark.read.parquet(*[f"{root}/done/{a:03d}" for a in range(attempt + 1)])
        left = real.join(done, ["kind", "canon"], "left_anti")
        left.write.parquet(f"{root}/pending/{attempt:03d}")
        pending = spark.read.parquet(f"{root}/pending/{attempt:03d}")
        if pending.isEmpty():
            return done.select("kind", "canon", "surrogate")
    raise RuntimeError("surrogates still collide; allow more rounds")


def _fill(kind: Column, m: Column, body: Column, new: Column) -> Column:
    """The surrogate in the mention's own format."""
    # digits of the surrogate, in order, at the places of the mention's digits
    symbols = F.split(body, "")
    slots = F.transform(symbols, lambda c, i: F.struct(c.alias("c"), F.size(F.filter(
        F.slice(symbols, 1, i + 1), lambda x: x.rlike("[A-Z0-9]"))).alias("n")))
    placed = F.array_join(F.transform(slots, lambda s: F.when(
        s["c"].rlike("[A-Z0-9]"), F.substr(new[0], s["n"], F.lit(1))).otherwise(s["c"])), "")
    return F.when(kind.isin("phone", "card", "ssn", "iban"), placed).otherwise(
        F.array_join(new, " "))


def replace_entities(df: DataFrame, key: str, text_col: str = "text",
                     count_col: str = "n_entities") -> DataFrame:
    """``df`` with ``text_col`` rewritten and ``count_col`` (mentions replaced) added,
    with underscores after its name where that is taken.

    ``key`` makes surrogates reproducible and unguessable; the same key maps
    an entity to the same surrogate in every document of the table.
    """
    at = place(df, text_col)
    rows = numbered(df).select(whole_rows(df).alias("row"), F.col(f"c{at}").alias("t"))
    maybe = F.coalesce(F.col("t").rlike(_MAYBE), F.lit(False))
    rows = rows.withColumn("found", F.when(maybe, F.regexp_extract_all("t", F.lit(MENTION), 0)))
    rows = rows.withColumn("sha", F.when(F.size("found") > 0, F.sha2("t", 256)))
    kind, m, prefix = F.col("kind"), F.col("m"), F.col("prefix")
    mentions = (rows.where(F.col("sha").isNotNull())
                .select("sha", F.posexplode("found").alias("place", "m")).distinct()
                .withColumn("kind", _type(m)).withColumn("prefix", _prefix(kind, m))
                .withColumn("body", F.substr(m, F.length(prefix) + 1)))
    parts = mentions.select("sha", "place", "kind", "m", "prefix", "body",
                            F.posexplode(_entities(kind, m, F.col("body"))).alias("part", "e"))
    parts = parts.select("sha", "place", "m", "prefix", "body", "part",
                         F.col("kind").alias("mention_kind"), "e.kind", "e.canon")
    known = surrogate_map(parts.select("kind", "canon").distinct(), key)
    filled = (parts.join(known, ["kind", "canon"])
              .groupBy("sha", "place", "m", "mention_kind", "prefix", "body")
              .agg(F.transform(F.sort_array(F.collect_list(F.struct("part", "surrogate"))),
                               lambda x: x["surrogate"]).alias("new"))
              .select("sha", F.struct("place", F.concat("prefix", _fill(
                  F.col("mention_kind"), m, F.col("body"), F.col("new"))).alias("s")).alias("r"),
                  F.when((F.col("mention_kind") == "name") & (F.size("new") > 1), F.struct(
                      F.col("body").alias("name"), F.array_join("new", " ").alias("new"))).alias("known")))
    per_text = filled.groupBy("sha").agg(F.sort_array(F.collect_list("r")).alias("r"),
                                         F.collect_set("known").alias("known"))
    between = F.col("between")  # text around mentions, split once
    gaps = F.transform(between, lambda g: F.aggregate("known", g, lambda text, k: F.regexp_replace(
        text, F.concat(F.lit(_BEFORE), k["name"], F.lit(_AFTER)), k["new"])))
    new_text = F.array_join(F.flatten(F.zip_with(gaps, F.transform("r", lambda x: x["s"]), lambda g, s: (
        F.array(g, F.coalesce(s, F.lit(""))))), ), "")
    cut = F.transform(between, lambda g: F.aggregate("known", F.lit(0), lambda n, k: n + ((F.length(g) - F.length(
        F.regexp_replace(g, F.concat(F.lit(_BEFORE), k["name"], F.lit(_AFTER)), F.lit("")))) / F.length(
            k["name"])).cast("int")))
    bare = F.aggregate(cut, F.lit(0), lambda a, b: a + b)
    hit = (rows.where(F.col("sha").isNotNull()).join(per_text, "sha")
           .select("row", "found", "known", "r", F.split("t", MENTION, -1).alias("between"))
           .select("row", new_text.alias("t"), (F.size("found") + bare).alias("n")))
    rest = rows.where(F.col("sha").isNull()).select("row", "t", F.lit(0).alias("n"))
    both = hit.unionByName(rest)
    out = [F.col("t").alias(c) if i == at else F.col(f"row.c{i}").alias(c)
           for i, c in enumerate(df.columns)]
    return both.select(*out, F.col("n").alias(free_name(count_col, df.columns)))
