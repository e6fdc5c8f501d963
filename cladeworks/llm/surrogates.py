"""Personal data replaced by keyed surrogates, in DataFrame functions only.

Entities are found by patterns: addresses, secrets, account, card and telephone numbers,
and names, which follow a title or begin with a given name of :data:`GIVEN`. A card
number must pass its check digit and an address of numbers have parts below 256, or they
are left alone. A name is taken apart into given and family names, each an entity of its
own whatever title stands before it, so that ``Mrs Maria Lopez``, ``Dr Lopez`` and
``Maria Lopez`` go on naming one person.

An entity's canonical form (its letters and digits, lower-cased; an address of numbers as
it stands) gets one surrogate, drawn from a keyed hash, in all documents and reruns. A
name's is a name of the same script, a given name's of the same gender (that of the list,
else of its titles), made of :data:`STEMS` and :data:`ENDINGS`. Anything else keeps its
length and the kind of character at each place; checked numbers stay valid (Luhn), address
parts stay below 256, country codes and key prefixes stay. Surrogates are checked against
each other and against all originals; all but one of those that collide draw again until
none does. Names grow by a stem every few draws; other forms from ROUNDS draws on get a
number behind, so that a form with more originals than surrogates gets longer ones.
Each mention keeps its own punctuation and capitals.

Defined results: null text stays null, empty text empty; repeated rows are rewritten
each; identifiers may be null or repeat; an empty table gives no rows; other columns
pass through :func:`rewritten`'s callers as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table, written

TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "г-н", "господин"), "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "г-жа", "госпожа"), "n": ("Dr", "Prof")}
_TITLED = "|".join(t for g in TITLES.values() for t in g)
#: Given names that begin a name without a title, by gender.
GIVEN = {
    "f": "Maria Anna Anne Julia Laura Sarah Emma Sofia Sophie Elena Carmen Isabel Lucia Marta Teresa Rosa Claudia Katharina Susanne Sabine Petra Monika Heike Ursula Camille Chloé Claire Nathalie Isabelle Céline Élodie Mary Elizabeth Jennifer Linda Susan Jessica Karen Emily Olivia Анна Мария Елена Ольга Наталья Татьяна Ирина",
    "m": "John James Robert Michael William David Richard Thomas Charles Daniel Matthew Andrew Peter Paul Hans Jürgen Klaus Wolfgang Stefan Andreas Markus Dieter Jean Pierre Jacques Philippe François Nicolas Julien Antoine José Juan Carlos Luis Miguel Javier Manuel Francisco Antonio Pedro Александр Сергей Дмитрий Андрей Алексей Иван Михаил",
}
_GIVEN = "|".join(n for names in GIVEN.values() for n in names.split())
#: type, pattern; earlier ones win. Boundaries keep parts of longer numbers and words out.
PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}"),
    ("secret", r"\b(?:password|passwd|pwd|token|secret|api_?key)\s?[=:]\s?[^\s,;\"']{6,}|\bAKIA[0-9A-Z]{16}\b|\b[0-9a-f]{32,64}\b"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("ip", r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\w|\.[0-9])"),
    ("ssn", r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    ("card", r"(?<![\w.-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2,3}(?:[ -][0-9]{1,3})?)(?![\w-])"),
    ("phone", r"(?<![\w.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3}[ .-][0-9]{3,4}(?!\w)|(?<![\w.])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?!\w)"),
    ("name", r"(?<=\b(?:" + _TITLED + r")\.? )\p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+)?|(?<![\p{L}\p{N}])(?=\p{Lu})(?:" + _GIVEN + r")(?: \p{Lu}[\p{L}'’-]+){1,2}"),
)
PATTERN = "|".join(p for _, p in PATTERNS)
#: Cheap sign that a text may hold an entity: whatever fits PATTERN holds it. Cards, numbers and most phones have three digits in a
#: row, other phones a plus and a digit, an iban two capitals and two digits.
SIGN = r"[0-9]{3}|[0-9]\.[0-9]|@|\+[0-9]|AKIA|[A-Z]{2}[0-9]{2}|[0-9a-f]{32}|(?:password|passwd|pwd|token|secret|key)\s?[=:]|\b(?:" + _TITLED + r")\.? \p{Lu}|(?<![\p{L}\p{N}])(?=\p{Lu})(?:" + _GIVEN + r") \p{Lu}"
VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу", "greek": "αειου"}
CONSONANTS = {"latin": "bcdfghjklmnprstvz", "cyrillic": "бвгдзклмнпрст", "greek": "βγδζκλμνπρστ"}
OTHER_VOWELS = {"latin": "yàáâãäåæèéêëìíîïòóôõöøùúûüýÿœ", "cyrillic": "ёыэюя", "greek": "ηωάέίόύήώ"}
#: What surrogate names are made of: stems, and endings of given names by gender and of family names.
STEMS = {
    "latin": "Al Bar Cor Dal Ed Fal Gar Hal Ir Jas Kel Lor Mer Nor Or Pel Quin Ros Sal Tal Ul Val Wil Yor Zel Bren Clar Dor Ferd Gil".split(),
    "cyrillic": "Ал Бор Вел Гор Дан Ев Жар Зор Ил Кал Лад Мир Нел Ор Пав Рад Сал Тим Фед Хар".split(),
    "greek": "Αλ Βασ Γερ Δημ Ελ Ζαν Ηλ Θεο Καλ Λεον Μαρ Νικ Ορ Παν Ροδ Σταμ Τιμ Φιλ Χαρ".split(),
}
ENDINGS = {
    "latin": {"f": "ina ella issa anda etta iana ora ila".split(), "m": "ian o ert ric ulf and enn is".split(), "n": "in el ar en is on".split(), "last": "berg ford mann ley sen owski etti aux ado ström wick ton".split()},
    "cyrillic": {"f": "ина ана ера ила".split(), "m": "ан ир ей ислав".split(), "n": "ан ин ей".split(), "last": "енко ский ин ов чук ак".split()},
    "greek": {"f": "ία ίνα έλα ώ".split(), "m": "ος ης ας ων".split(), "n": "ις ων".split(), "last": "όπουλος ίδης άκης ίου".split()},
}
KEY, ROUNDS = "cladeworks", 20


def entity_type(value: Column) -> Column:
    """The kind of what a pattern found, null where it fails its kind's check."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    checked = {
        "card": luhn_digit(F.substring(digits, F.lit(1), F.length(digits) - 1)) == F.right(digits, F.lit(1)),
        "ip": F.forall(F.split(value, r"\."), lambda x: x.cast("int") < 256),
    }
    kind = None
    for name, pattern in PATTERNS:
        fits = value.rlike(f"^(?:{pattern})$") if name != "name" else F.lit(True)
        found = F.when(checked[name], F.lit(name)) if name in checked else F.lit(name)
        kind = F.when(fits, found) if kind is None else kind.when(fits, found)
    return kind


def canonical(value: Column, kind: Column) -> Column:
    return F.when(kind == "ip", value).otherwise(F.lower(F.regexp_replace(value, r"[^\p{L}\p{N}]", "")))


def _pick(letters: str, n: Column) -> Column:
    return F.substring(F.lit(letters), (n % len(letters) + 1).cast("int"), F.lit(1))


def _drawn(seed: Column, i: Column) -> Column:
    """The i-th of 63 numbers (from 1) that a hash of 128 hexadecimal digits holds."""
    return F.conv(F.substring(seed, ((i - 1) % 63 * 2 + 1).cast("int"), F.lit(4)), 16, 10).cast("long")


def name_surrogate(kind: Column, gender: Column, canon: Column, seed: Column, attempt: Column) -> Column:
    """A name of the canonical form's script, in lower case; it has a stem more each third attempt."""
    out = None
    for script, stems in STEMS.items():
        listed, many = F.array(*(F.lit(x.lower()) for x in stems)), len(stems)
        stem = F.element_at(listed, (_drawn(seed, F.lit(1)) % many + 1).cast("int"))
        more = F.transform(F.sequence(F.lit(1), F.greatest(F.floor(attempt / 3), F.lit(1)).cast("int")), lambda k: F.element_at(listed, (_drawn(seed, k + 3) % many + 1).cast("int")))
        end = None
        for g, ends in ENDINGS[script].items():
            own = F.element_at(F.array(*map(F.lit, ends)), (_drawn(seed, F.lit(2)) % len(ends) + 1).cast("int"))
            wanted = (kind == "last") if g == "last" else (kind == "first") & (gender == g)
            end = F.when(wanted, own) if end is None else end.when(wanted, own)
        name = F.concat(F.when(attempt >= 3, F.array_join(more, "")).otherwise(""), stem, end)
        inside = canon.rlike({"latin": r"\p{IsLatin}$", "cyrillic": r"\p{IsCyrillic}$", "greek": r"\p{IsGreek}$"}[script])
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return out


def surrogate(kind: Column, gender: Column, canon: Column, attempt: Column) -> Column:
    """The surrogate that a canonical form draws at an attempt."""
    seed = F.sha2(F.concat_ws("|", F.lit(KEY), kind, canon, attempt.cast("string")), 512)
    number = lambda i: _drawn(seed, i)
    length = F.length(canon)
    keep = (
        F.when((kind == "phone") & canon.startswith("1") & (length == 11), 1)
        .when((kind == "secret") & canon.startswith("akia"), 4)
        .when(kind == "secret", F.length(F.regexp_extract(canon, "^(password|passwd|pwd|token|secret|api_?key)", 1)))
        .when(kind == "iban", 2)
        .otherwise(0)
    )
    tail = F.when(kind == "email", F.length(F.regexp_extract(canon, "(com|org|net|edu|gov|[a-z]{2})$", 1))).otherwise(0)

    def one(i: Column) -> Column:
        c = F.substring(canon, i, F.lit(1))
        out = F.when((i <= keep) | (i > length - tail), c).when((c >= "0") & (c <= "9"), (number(i) % 10).cast("string"))
        hexes = (kind == "secret") & canon.rlike("^[0-9a-f]+$|^(password|passwd|pwd)[0-9a-f]+$")
        out = out.when(hexes, _pick("abcdef", number(i)))
        for script in VOWELS:
            vowel = F.lit(VOWELS[script] + OTHER_VOWELS[script]).contains(c)
            letter = F.lit(CONSONANTS[script] + ("qwxçñß" if script == "latin" else "жйфхцчшщъь" if script == "cyrillic" else "θξφχψς")).contains(c)
            out = out.when(vowel, _pick(VOWELS[script], number(i))).when(letter, _pick(CONSONANTS[script], number(i)))
        return out.otherwise(c)

    text = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(length, F.lit(1))), one), "")
    octets = F.concat_ws(".", *((number(F.lit(k + 1)) % 254 + 1).cast("string") for k in range(4)))
    body = F.substring(text, F.lit(1), length - 1)
    checked = F.concat(body, luhn_digit(body))
    name = name_surrogate(kind, gender, canon, seed, attempt)
    return F.when(kind == "ip", octets).when(kind == "card", checked).when(kind.isin("first", "last") & name.isNotNull(), name).otherwise(text)


def luhn_digit(body: Column) -> Column:
    """The check digit that makes body + digit valid."""
    n = F.length(body)

    def add(acc: Column, i: Column) -> Column:
        d = F.ascii(F.substring(body, i, F.lit(1))) - 48
        twice = F.when((n - i) % 2 == 0, d * 2).otherwise(d)
        return acc + F.when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add)
    return ((F.lit(10) - total % 10) % 10).cast("string")


def longer(kind: Column, canon: Column, base: Column, number: Column, width: int) -> Column:
    """A surrogate beyond its form's space: what was drawn and a number of at least ``width`` digits, as letters for words.
    A draw that is the original itself gives way to letters or digits of its hash."""
    digits = F.lpad(number.cast("string"), width, "0")
    digits = F.when(F.length(number.cast("string")) > width, number.cast("string")).otherwise(digits)
    letters = kind.isin("email", "secret", "first", "last")
    own = F.sha2(F.concat_ws("|", F.lit(KEY), kind, canon, F.lit(str(width))), 256)
    base = F.when(base != canon, base).when(letters, F.translate(F.substring(own, 1, 8), "0123456789abcdef", "bcdfghjklmnprstv")).otherwise(F.translate(F.substring(own, 1, 12), "abcdef", "135790"))
    spelt = F.translate(digits, "0123456789", "bcdfghjklm")
    body = F.concat(base, digits)
    return F.when(kind == "ip", F.concat(base, F.lit("."), digits)).when(kind == "email", F.concat(spelt, base)).when(letters, F.concat(base, spelt)).when(kind == "card", F.concat(body, luhn_digit(body))).otherwise(body)


def rendered(value: Column, kind: Column, new: Column) -> Column:
    """A mention with its letters and digits replaced in order, capitals and punctuation as they were. What a longer surrogate
    has more goes before an address and behind anything else. A name is put as a whole, in capitals if the mention is."""
    held = F.length(F.regexp_replace(value, r"[^\p{L}\p{N}]", ""))
    more = F.greatest(F.length(new) - held, F.lit(0))
    shift = F.when(kind == "email", more).otherwise(0)

    def one(acc: Column, c: Column) -> Column:
        x = F.substring(new, acc["k"] + 1 + shift, F.lit(1))
        put = F.when(F.lower(c) != c, F.upper(x)).otherwise(x)
        sign = ~c.rlike(r"[\p{L}\p{N}]")
        return F.struct(F.when(sign, acc["k"]).otherwise(acc["k"] + 1).alias("k"), F.concat(acc["out"], F.when(sign, c).otherwise(put)).alias("out"))

    same = F.aggregate(F.split(value, ""), F.struct(F.lit(0).alias("k"), F.lit("").alias("out")), one)["out"]
    rest = F.substring(new, F.when(kind == "email", F.lit(1)).otherwise(held + 1), more)
    capitals = (F.upper(value) == value) & (F.lower(value) != value)
    rest = F.when(capitals, F.upper(rest)).otherwise(rest)
    name = F.when(capitals & (F.length(value) > 1), F.upper(new)).otherwise(F.initcap(new))
    return F.when(kind == "ip", new).when(kind.isin("first", "last"), name).when(more == 0, same).when(kind == "email", F.concat(rest, same)).otherwise(F.concat(same, rest))


def assigned(entities: DataFrame) -> DataFrame:
    """kind, canon, surrogate of distinct entities (kind, gender, canon), no two of a kind alike and none like an original.

    Given and family names are of one kind here. An entity of several genders has the first of f, m, n.
    """
    spark = entities.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left = written(entities.groupBy("kind", "canon").agg(F.min("gender").alias("gender")).withColumn("space", F.when(F.col("kind").isin("first", "last"), "name").otherwise(F.col("kind"))), "entities")
    originals = left.select("space", F.col("canon").alias("surrogate")).distinct().withColumn("_o", F.lit(1))
    done, attempt = None, 0
    first = Window.partitionBy("space", "surrogate").orderBy("canon", "kind")
    while True:
        # drawing costs far more than its rows' bytes tell
        drawn = left.repartition(tasks, "canon").withColumn("surrogate", surrogate(F.col("kind"), F.col("gender"), F.col("canon"), F.lit(attempt)))
        if attempt >= ROUNDS:
            # the form's space is used up, or nearly: longer ones, a place longer each round, so that they outgrow all originals
            drawn = drawn.withColumn("_n", F.row_number().over(first))
            drawn = drawn.withColumn("surrogate", longer(F.col("kind"), F.col("canon"), F.col("surrogate"), F.col("_n"), attempt - ROUNDS + 1))
        same = drawn.select("space", "kind", "gender", "canon", "surrogate").join(originals, ["space", "surrogate"], "left")
        if done is not None:
            same = same.join(done.select("space", "surrogate", F.lit(1).alias("_d")), ["space", "surrogate"], "left")
        else:
            same = same.withColumn("_d", F.lit(None).cast("int"))
        judged = written(same.withColumn("_ok", F.col("_o").isNull() & F.col("_d").isNull() & (F.row_number().over(first) == 1)), "surrogates")
        new = judged.where("_ok").select("space", "kind", "canon", "surrogate")
        done = new if done is None else written(done.union(new), "surrogates")
        left = judged.where(~F.col("_ok")).select("kind", "gender", "canon", "space")
        if left.isEmpty():
            return done.select("kind", "canon", "surrogate")
        attempt += 1


def rewritten(docs: DataFrame) -> DataFrame:
    """``docs`` as struct ``_row`` with ``_text`` rewritten and ``_kinds`` the types of its entities in order."""
    rows = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_old"))
    found = F.when(F.col("_old").rlike(SIGN), F.regexp_extract_all("_old", F.lit(PATTERN), F.lit(0)))
    rows = rows.withColumn("_found", F.when(F.size(found) > 0, found))
    plain = rows.where(F.col("_found").isNull()).select("_row", F.col("_old").alias("_text"), F.array().cast("array<string>").alias("_kinds"))
    held = written(rows.where(F.col("_found").isNotNull()).select("_row", "_old", "_found", F.split("_old", PATTERN, -1).alias("_between")).withColumn("_id", F.monotonically_increasing_id()), "entity-texts")
    title = lambda g: rf"\b(?:{'|'.join(TITLES[g])})\.? $"
    before = F.get("_between", F.col("_at"))
    titled = F.when(F.col("kind") != "name", "").when(before.rlike(title("f")), "f").when(before.rlike(title("m")), "m").otherwise("n")
    each = held.select("_id", "_between", F.posexplode("_found").alias("_at", "value")).withColumn("kind", entity_type(F.col("value")))
    each = each.select("_id", "_at", "value", "kind", titled.alias("gender"))
    # a name's words are entities of their own
    pieces = F.when(F.col("kind") == "name", F.split("value", " ")).otherwise(F.array("value"))
    each = each.select("_id", "_at", "kind", "gender", F.size(pieces).alias("_all"), F.posexplode(pieces).alias("_part", "value"))
    listed = {g: F.col("value").isin(names.split()) for g, names in GIVEN.items()}
    family = (F.col("_part") == F.col("_all") - 1) & ~((F.col("_all") == 1) & (listed["f"] | listed["m"]))
    named = F.col("kind") == "name"
    gender = F.when(~named | family, "").when(listed["f"], "f").when(listed["m"], "m").otherwise(F.col("gender"))
    each = each.select("_id", "_at", "_part", "value", F.when(named & family, "last").when(named, "first").otherwise(F.col("kind")).alias("kind"), gender.alias("gender"))
    each = written(each.withColumn("canon", canonical(F.col("value"), F.col("kind"))), "entity-mentions")
    of = assigned(each.where(F.col("kind").isNotNull()).select("kind", "gender", "canon"))
    put = each.join(of, ["kind", "canon"], "left")
    new = F.when(F.col("kind").isNull(), F.col("value")).otherwise(rendered(F.col("value"), F.col("kind"), F.col("surrogate")))
    put = put.groupBy("_id", "_at").agg(F.array_sort(F.collect_list(F.struct("_part", "kind", new.alias("new")))).alias("_p"))
    kind = F.when(F.get("_p", F.lit(0))["kind"].isin("first", "last"), "name").otherwise(F.get("_p", F.lit(0))["kind"])
    put = put.select("_id", F.struct("_at", kind.alias("kind"), F.array_join(F.transform("_p", lambda p: p["new"]), " ").alias("new")).alias("_m"))
    put = put.groupBy("_id").agg(F.array_sort(F.collect_list("_m")).alias("_m"))
    whole = F.array_join(F.zip_with("_between", F.transform("_m", lambda m: m["new"]), lambda x, y: F.concat(x, F.coalesce(y, F.lit("")))), "")
    changed = held.join(put, "_id").select("_row", whole.alias("_text"), F.array_compact(F.transform("_m", lambda m: m["kind"])).alias("_kinds"))
    return plain.union(changed)


def op4_surrogate_generation(spark, sf_dir: str) -> DataFrame:
    """Every document with its text rewritten, and how many entities of each type it had."""
    rows = rewritten(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("_kinds", lambda k: k == kind)).alias(f"n_{kind}")
    return rows.select("_row.doc_id", F.col("_text").alias("text"), F.size("_kinds").alias("n_entities"), *(count(k) for k, _ in PATTERNS))
