"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A keyed Feistel network permutes each value within its own format: a card number stays a number
of that length with a valid check digit, a date a date, an address of four octets such an
address. Equal values get equal pseudonyms in all documents, different ones different ones, and
nothing needs to be stored or joined: each text is rewritten in the scan.

Both halves of a value are whole numbers below two moduli. Round by round, a hash of key, kind
and one half is added to the other, so every round can be undone and the whole is a permutation.
Where a format allows fewer values than the moduli make, the network is applied again until the
result is allowed (cycle walking), which is a permutation of the allowed values.

Nulls and edge cases: a null text stays null with no values found, an empty one stays empty.
Runs of more than 19 digits, impossible dates and octets above 255 are not personal values.
Numbers without a valid check digit are no values to be hidden and stay as they are. Names of
addresses are rewritten whole, however long; very long texts are rewritten in the same scan. Rows
that share an id are separate documents. Other columns are kept as they are, but for ``n_values`` and
``n_changed`` of the input, which the counts replace.

Whoever has the key can undo the pseudonyms, so there is no default: the caller names a secret one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebase.llm.text import let

ROUNDS = 8
# For the registered query and its check only, which need the same rows in every run.
QUERY_KEY = "carebase"
DIGITS, LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"
# Longer values are permuted in parts, so that halves stay exact as whole numbers and doubles.
PART = {DIGITS: 18, LETTERS: 22}
FIRST_DAY, LAST_DAY = "1900-01-01", "2099-12-31"
N_DAYS = 73049
DAY_MODULI = (271, 270)  # their product is the smallest above the number of days

# The formats, tried in this order at every place.
_START, _END = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
FORMATS = {
    # From the first character of the name on, however long it is; no place is tried twice.
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iso_date": _START + r"(?:19|20)\d\d-\d\d-\d\d" + _END,
    "day_first": _START + r"\d\d\.\d\d\.(?:19|20)\d\d" + _END,
    "month_first": _START + r"\d\d/\d\d/(?:19|20)\d\d" + _END,
    "ip": r"(?<![A-Za-z0-9.])(?:\d{1,3}\.){3}\d{1,3}(?![A-Za-z0-9]|\.\d)",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}" + _END,
    "local_phone": r"\(\d{3}\) ?\d{3}[ .-]\d{4}" + _END,
    "ssn": _START + r"\d{3}-\d{2}-\d{4}" + _END,
    "iban": _START + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END,
    "grouped": _START + r"\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}" + _END,
    "number": _START + r"\d{9,19}" + _END,
}
DATES = {"iso_date": "yyyy-MM-dd", "day_first": "dd.MM.yyyy", "month_first": "MM/dd/yyyy"}
ANY = "|".join(f"(?:{pattern})" for pattern in FORMATS.values())


def _network(halves: tuple[Column, Column], moduli: tuple[Column, Column], tweak: Column) -> Column:
    """struct(a, b): the halves, each below its modulus, after an even number of rounds."""

    def one(state: Column, i: Column) -> Column:
        mixed = F.md5(F.concat_ws(":", tweak, i.cast("string"), state["b"].cast("string")))
        number = F.conv(F.substring(mixed, 1, 15), 16, 10).cast("long")
        modulus = F.when(i % 2 == 1, moduli[0]).otherwise(moduli[1])
        return F.struct(
            state["b"].alias("a"), ((state["a"] + number % modulus) % modulus).alias("b")
        )

    start = F.struct(halves[0].cast("long").alias("a"), halves[1].cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, one)


def _power(base: int, exponent: Column) -> Column:
    return F.round(F.pow(F.lit(float(base)), exponent)).cast("long")


def _number(text: Column, alphabet: str) -> Column:
    chars = F.array_remove(F.split(text, ""), "")
    return F.aggregate(
        chars,
        F.lit(0).cast("long"),
        lambda n, c: n * len(alphabet) + F.ascii(c).cast("long") - ord(alphabet[0]),
    )


def _spelled(number: Column, length: Column, alphabet: str) -> Column:
    base = len(alphabet)

    def one(state: Column, _: Column) -> Column:
        digit = state["n"] % base
        return F.struct(
            ((state["n"] - digit) / base).cast("long").alias("n"),
            F.concat(F.get(F.split(F.lit(alphabet), ""), digit.cast("int")), state["s"]).alias("s"),
        )

    places = F.slice(F.sequence(F.lit(1), F.lit(PART[alphabet])), F.lit(1), length)
    start = F.struct(number.alias("n"), F.lit("").alias("s"))
    return F.aggregate(places, start, one)["s"]


def permuted(text: Column, alphabet: str, tweak: Column) -> Column:
    """``text``, all of ``alphabet``, permuted among the texts of its length."""
    base = len(alphabet)

    def halves(piece: Column, n: Column, tag: Column) -> Column:
        u = ((n - n % 2) / 2).cast("int")
        numbers = (
            _number(F.substring(piece, F.lit(1), u), alphabet),
            _number(F.substring(piece, u + 1, n - u), alphabet),
        )
        mixed = _network(numbers, (_power(base, u), _power(base, n - u)), tag)
        return let(
            mixed,
            lambda m: F.concat(_spelled(m["a"], u, alphabet), _spelled(m["b"], n - u, alphabet)),
        )

    def whole(value: Column) -> Column:
        def part(k: Column) -> Column:
            start = (k * PART[alphabet] + 1).cast("int")
            return let(
                F.substring(value, start, F.lit(PART[alphabet])),
                lambda piece: let(
                    F.length(piece),
                    lambda n: let(
                        F.concat_ws(":", tweak, n.cast("string"), k.cast("string")),
                        lambda tag: halves(piece, n, tag),
                    ),
                ),
            )

        last = F.ceil(F.length(value) / PART[alphabet]).cast("int") - 1
        return F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), part), "")

    return let(text, whole)


def _put_back(template: Column, fresh: Column, pattern: str) -> Column:
    """``template`` with its characters that match ``pattern`` replaced by those of ``fresh``."""
    return let(fresh, lambda values: _filled(template, values, pattern))


def _filled(template: Column, values: Column, pattern: str) -> Column:
    def one(state: Column, c: Column) -> Column:
        hit = c.rlike(pattern)
        char = F.substring(values, state["i"] + 1, F.lit(1))
        char = F.when(c.rlike("[A-Z]"), F.upper(char)).otherwise(char)
        return F.struct(
            F.concat(state["s"], F.when(hit, char).otherwise(c)).alias("s"),
            (state["i"] + hit.cast("int")).alias("i"),
        )

    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("i"))
    return F.aggregate(F.array_remove(F.split(template, ""), ""), start, one)["s"]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _with_digits(match: Column, tweak: Column) -> Column:
    return _put_back(match, permuted(_digits(match), DIGITS, tweak), "[0-9]")


def luhn_sum(digits: Column) -> Column:
    """The sum of the digits, every second from the right, beginning with the last, doubled."""
    chars = F.array_remove(F.split(F.reverse(digits), ""), "")
    return F.aggregate(
        F.transform(
            chars,
            lambda c, i: F.when(i % 2 == 1, c.cast("int")).otherwise(
                c.cast("int") * 2 - F.when(c >= "5", 9).otherwise(0)
            ),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )


def _card_or_number(match: Column, tweak: Column) -> Column:
    """All digits but the last are permuted, and the last one is the check digit they ask for.
    A number without a valid check digit is left as it is."""

    def fresh(digits: Column) -> Column:
        n = F.length(digits)
        body, last = F.substring(digits, F.lit(1), n - 1), F.substring(digits, n, F.lit(1))

        def checked(new: Column) -> Column:
            return F.concat(new, F.pmod(-luhn_sum(new), F.lit(10)).cast("string"))

        valid = (luhn_sum(body) + last.cast("int")) % 10 == 0
        rewritten = _put_back(match, let(permuted(body, DIGITS, tweak), checked), "[0-9]")
        return F.when(valid, rewritten).otherwise(match)

    return let(_digits(match), fresh)


def _mod97(text: Column) -> Column:
    """The remainder of an account number, letters counting from 10."""
    chars = F.array_remove(F.split(text, ""), "")
    return F.aggregate(
        chars,
        F.lit(0),
        lambda r, c: F.when(c.rlike("[0-9]"), (r * 10 + c.try_cast("int")) % 97).otherwise(
            (r * 100 + F.ascii(c) - 55) % 97
        ),
    )


def _iban(match: Column, tweak: Column) -> Column:
    """Valid account numbers keep country and letters and get new check digits."""

    def fresh(plain: Column) -> Column:
        country, rest = F.substring(plain, 1, 2), F.substring(plain, 5, 40)
        valid = _mod97(F.concat(rest, F.substring(plain, 1, 4))) == 1

        def checked(new: Column) -> Column:
            left = F.lit(98) - _mod97(F.concat(new, country, F.lit("00")))
            return F.concat(F.lpad(left.cast("string"), 2, "0"), _digits(new))

        permuted_rest = _with_digits(rest, F.concat_ws(":", tweak, country))
        return F.when(valid, _put_back(match, let(permuted_rest, checked), "[0-9]")).otherwise(match)

    return let(F.regexp_replace(match, " ", ""), fresh)


def _ip(match: Column, tweak: Column) -> Column:
    modulus = F.lit(65536).cast("long")

    def pair(half: Column) -> list[Column]:
        low = half % 256
        return [((half - low) / 256).cast("long").cast("string"), low.cast("string")]

    def fresh(octets: Column) -> Column:
        a, b, c, d = (F.get(octets, F.lit(i)) for i in range(4))
        mixed = _network((a * 256 + b, c * 256 + d), (modulus, modulus), tweak)
        spelled = let(mixed, lambda m: F.concat_ws(".", *pair(m["a"]), *pair(m["b"])))
        return F.when(F.forall(octets, lambda o: o <= 255), spelled).otherwise(match)

    return let(F.transform(F.split(match, r"\."), lambda o: o.cast("long")), fresh)


def _date(match: Column, pattern: str, tweak: Column) -> Column:
    first, width = F.lit(FIRST_DAY).cast("date"), DAY_MODULI[1]
    moduli = tuple(F.lit(m).cast("long") for m in DAY_MODULI)

    def step(n: Column) -> Column:
        low = n % width
        mixed = _network((((n - low) / width).cast("long"), low), moduli, tweak)
        return let(mixed, lambda m: m["a"] * width + m["b"])

    def fresh(day: Column) -> Column:
        # After the first step, further ones only while the result lies beyond the last day.
        moved = F.aggregate(
            F.sequence(F.lit(1), F.lit(32)),
            day.cast("long"),
            lambda n, i: F.when((i == 1) | (n >= N_DAYS), step(n)).otherwise(n),
        )
        spelled = F.date_format(F.date_add(first, moved.cast("int")), pattern)
        return F.when(day.isNull(), match).otherwise(spelled)

    return let(F.datediff(F.try_to_timestamp(match, F.lit(pattern)).cast("date"), first), fresh)


def _email(match: Column, tweak: Column) -> Column:
    local, domain = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
    letters = F.lower(F.regexp_replace(local, "[^A-Za-z]", ""))
    fresh = _put_back(local, permuted(letters, LETTERS, tweak), "[A-Za-z]")
    return F.concat(let(fresh, lambda new: _with_digits(new, tweak)), F.lit("@"), domain)


def _phone(match: Column, tweak: Column) -> Column:
    country = F.regexp_extract(match, r"^\+\d{1,3}", 0)
    rest = F.substring(match, F.length(country) + 1, F.length(match))
    return F.concat(country, _with_digits(rest, F.concat_ws(":", tweak, country)))


def pseudonym(match: Column, key: str) -> Column:
    """The pseudonym of one match of ``ANY``; the match itself if it isn't valid."""
    plain = F.lit(key)
    rewrite = {
        "email": _email,
        "ip": _ip,
        "phone": _phone,
        "iban": _iban,
        "grouped": _card_or_number,
        "number": _card_or_number,
    }
    result = None
    for kind, pattern in FORMATS.items():
        tweak = F.concat_ws(":", plain, F.lit("number" if kind == "grouped" else kind))
        if kind in DATES:
            tweak = F.concat_ws(":", plain, F.lit("date"))
            fresh = _date(match, DATES[kind], tweak)
        else:
            fresh = rewrite.get(kind, _with_digits)(match, tweak)
        whole = match.rlike(f"^(?:{pattern})$")
        result = F.when(whole, fresh) if result is None else result.when(whole, fresh)
    return result.otherwise(match)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with a rewritten text and two more columns, n_values and n_changed: how many
    values have one of the formats, and how many of these are valid and were rewritten."""
    text = docs["text"]
    has_any = text.rlike(ANY)
    values = F.when(has_any, F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    gaps = F.when(has_any, F.split(text, ANY, -1))
    rest = [c for c in docs.columns if c not in ("n_values", "n_changed")]
    v, g, f = (_unused(name, docs.columns) for name in ("values", "gaps", "fresh"))
    found = docs.select(*rest, values.alias(v), gaps.alias(g))
    fresh = found.withColumn(f, F.transform(v, lambda m: pseudonym(m, key)))
    joined = F.array_join(
        F.zip_with(g, F.concat(f, F.array(F.lit(""))), lambda gap, new: F.concat(gap, new)), ""
    )
    changed = F.filter(F.zip_with(v, f, lambda a, b: a != b), lambda x: x)
    return fresh.select(
        *(F.coalesce(joined, "text").alias("text") if c == "text" else c for c in rest),
        F.coalesce(F.size(v), F.lit(0)).cast("long").alias("n_values"),
        F.coalesce(F.size(changed), F.lit(0)).cast("long").alias("n_changed"),
    )


def _unused(name: str, columns: list[str]) -> str:
    """``name`` with underscores in front of it until no column is called so."""
    while name.lower() in {column.lower() for column in columns}:
        name = f"_{name}"
    return name


def op6_pseudonyms(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs, QUERY_KEY)
