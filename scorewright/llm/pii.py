"""Format-preserving pseudonyms for personal data.

Validated numbers (payment cards, phone numbers, social security numbers, IPv4 addresses) and dates are permuted by a
keyed Feistel network over exactly the valid values of their format: the result is valid again, different values stay
different, and equal values are equal in all documents. The network splits a value into two numbers x < a and y < b
and alternates x += f(round, y) mod a and y += f(round, x) mod b, where f is keyed SHA-256. E-mail addresses and
secrets are no numbers: their private part is replaced by a keyed digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import replace_columns

ROUNDS = 8
FIRST_DAY, DAYS_A, DAYS_B = "1900-01-01", 340, 215  # 73 100 days, to 2100-02-19
KINDS = ("card", "phone", "ssn", "ip", "date", "email", "secret")

# The forms that are looked for. No part matches within a longer run of letters or digits.
_L, _R = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
CARD = _L + r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})" + _R
PHONE = _L + r"(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}" + _R
SSN = _L + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _R
IP = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
DATE = _L + r"(?:[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4})" + _R
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
ASSIGNED = _L + r"(?i:token|password|passwd|secret|api_?key)[ \t]*[=:][ \t]*[\"']?[A-Za-z0-9+/_-]{8,}+"
ACCESS_KEY = _L + r"AKIA[0-9A-Z]{16}" + _R
HEX = _L + r"[0-9A-Fa-f]{32,}+" + _R
ANY = "|".join((ASSIGNED, ACCESS_KEY, HEX, EMAIL, CARD, IP, DATE, SSN, PHONE))
HINT = "[0-9@=:]"  # every form has one of these
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def _number(c: Column) -> Column:
    return c.cast("long")


def _power(n: Column) -> Column:
    """10 to the power n, for n up to 18."""
    return _number(F.rpad(F.lit("1"), n + 1, "0"))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def feistel(x: Column, y: Column, a: Column, b: Column, key: str, tweak: Column) -> Column:
    """The keyed permutation of the pairs x < a, y < b, as a struct of x and y. a and b are at most 10^9."""

    def f(i: Column, v: Column, m: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), v.cast("string")).cast("binary"), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % m

    def one(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, (s["x"] + f(i, s["y"], a)) % a).otherwise(s["x"]).alias("x"),
            F.when(even, s["y"]).otherwise((s["y"] + f(i, s["x"], b)) % b).alias("y"),
        )

    start = F.struct(_number(x).alias("x"), _number(y).alias("y"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one)


def _with(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _luhn(digits: Column, first: int) -> Column:
    """Luhn sum with the doubling starting at the last digit (first=1) or the one before it (first=0)."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == first, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _rewritten(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced in order."""

    def at(i: Column) -> Column:
        c = F.substring(m, i, F.lit(1))
        return F.when(c.rlike("[0-9]"), F.substring(digits, F.length(_digits(F.substring(m, F.lit(1), i))), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), at), "")


def _card(m: Column, key: str) -> Column:
    """The digits between the first and the check digit are permuted; the check digit is made anew."""

    def new(d: Column) -> Column:
        k = F.length(d) - 2
        high = F.ceil(k / 2).cast("int")
        body = F.substring(d, F.lit(2), k)
        moved = feistel(F.substring(body, F.lit(1), high), F.substring(body, high + 1, k - high), _power(high), _power(k - high), key, F.concat(F.lit("card"), F.length(d).cast("string")))
        start = _with(moved, lambda s: F.concat(F.substring(d, 1, 1), F.lpad(s["x"].cast("string"), high, "0"), F.lpad(s["y"].cast("string"), k - high, "0")))
        return _with(start, lambda p: F.concat(p, ((10 - _luhn(p, 1) % 10) % 10).cast("string")))

    return _rewritten(m, _with(_digits(m), new))


def _phone(m: Column, key: str) -> Column:
    """Area and exchange codes from 200 are permuted among themselves; a lower one stays and the rest is permuted."""

    def new(d: Column) -> Column:
        area, exchange, line = (_number(F.substring(d, a, n)) for a, n in ((1, 3), (4, 3), (7, 4)))
        pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
        both = feistel((area - 200) * 100 + F.floor(line / 100), (exchange - 200) * 100 + line % 100, F.lit(80000), F.lit(80000), key, F.lit("phone"))
        valid = _with(both, lambda s: F.concat(pad(F.floor(s["x"] / 100) + 200, 3), pad(F.floor(s["y"] / 100) + 200, 3), pad(s["x"] % 100, 2), pad(s["y"] % 100, 2)))
        low_area = _with(feistel(line, exchange, F.lit(10000), F.lit(1000), key, F.concat(F.lit("phone-a"), area.cast("string"))), lambda s: F.concat(pad(area, 3), pad(s["y"], 3), pad(s["x"], 4)))
        low_exchange = _with(feistel(line, area - 200, F.lit(10000), F.lit(800), key, F.concat(F.lit("phone-e"), exchange.cast("string"))), lambda s: F.concat(pad(s["y"] + 200, 3), pad(exchange, 3), pad(s["x"], 4)))
        return F.when(area < 200, low_area).when(exchange < 200, low_exchange).otherwise(valid)

    digits = _digits(m)
    return _rewritten(m, F.concat(F.substring(digits, F.lit(1), F.length(digits) - 10), _with(F.substring(digits, F.length(digits) - 9, F.lit(10)), new)))


def _ssn(m: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups from 01, serials from 0001."""
    area, group, serial = (_number(F.substring(m, a, n)) for a, n in ((1, 3), (5, 2), (8, 4)))
    x = (area - 1 - (area > 666).cast("int")) * 99 + group - 1
    moved = feistel(x, serial - 1, F.lit(898 * 99), F.lit(9999), key, F.lit("ssn"))

    def out(s: Column) -> Column:
        a = F.floor(s["x"] / 99) + 1
        return F.concat_ws("-", F.lpad((a + (a >= 666).cast("int")).cast("string"), 3, "0"), F.lpad((s["x"] % 99 + 1).cast("string"), 2, "0"), F.lpad((s["y"] + 1).cast("string"), 4, "0"))

    return _with(moved, out)


def _ip(m: Column, key: str) -> Column:
    octets = F.split(m, r"\.")
    two = lambda i: _number(F.get(octets, F.lit(i))) * 256 + _number(F.get(octets, F.lit(i + 1)))
    moved = feistel(two(0), two(2), F.lit(65536), F.lit(65536), key, F.lit("ip"))
    return _with(moved, lambda s: F.concat_ws(".", *(c.cast("string") for n in ("x", "y") for c in (F.floor(s[n] / 256), s[n] % 256))))


DATE_FORMS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy")


def _days(m: Column, form: str) -> Column:
    """Days since FIRST_DAY of a valid date of this form within the domain, else null."""
    shaped = m.rlike("^" + form.replace(".", r"\.").replace("yyyy", "[0-9]{4}").replace("MM", "[0-9]{2}").replace("dd", "[0-9]{2}") + "$")
    n = F.datediff(F.when(shaped, F.try_to_date(m, form)), F.lit(FIRST_DAY).cast("date"))
    return F.when((n >= 0) & (n < DAYS_A * DAYS_B), n)


def _date(m: Column, key: str) -> Column:
    """A date keeps its form, and is the same day in every form. Day before month where both readings are valid."""

    def moved(n: Column, form: str) -> Column:
        s = feistel(F.floor(n / DAYS_B), n % DAYS_B, F.lit(DAYS_A), F.lit(DAYS_B), key, F.lit("date"))
        day = _with(s, lambda s: F.date_add(F.lit(FIRST_DAY).cast("date"), (s["x"] * DAYS_B + s["y"]).cast("int")))
        return F.date_format(day, form)

    return F.coalesce(*(F.when(_days(m, form).isNotNull(), moved(_days(m, form), form)) for form in DATE_FORMS))


def _digest(value: Column, key: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), value).cast("binary"), 256)


def _email(m: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substring(_digest(F.lower(m), key), 1, 12), F.lit("@"), F.substring_index(m, "@", -1))


def _assigned(m: Column, key: str) -> Column:
    """The value after = or : becomes as many hexadecimal digits of its keyed digest."""
    value = F.regexp_extract(m, "[A-Za-z0-9+/_-]{8,}$", 0)
    name = F.substring(m, F.lit(1), F.length(m) - F.length(value))
    return F.concat(name, F.rpad(_digest(value, key), F.length(value), _digest(F.reverse(value), key)))


def _hex(m: Column, key: str) -> Column:
    """As many hexadecimal digits of its keyed digest, in its case; beyond 128 they repeat."""
    both = F.concat(_digest(m, key), _digest(F.reverse(m), key))
    new = F.rpad(both, F.length(m), both)
    return F.when(m == F.upper(m), F.upper(new)).otherwise(new)


def _access_key(m: Column, key: str) -> Column:
    return F.concat(F.lit("AKIA"), F.upper(F.substring(_digest(m, key), 1, 16)))


def _pseudonym(m: Column, key: str) -> Column:
    """Struct of kind and value; what fails validation keeps its value and has no kind."""
    card, digits = m.rlike(_whole(CARD)), _digits(m)
    ssn = m.rlike(_whole(SSN)) & ~m.rlike("^(?:000|666|9)|-00-|-0000$")
    date = m.rlike(_whole(DATE)) & F.coalesce(*(_days(m, f) for f in DATE_FORMS)).isNotNull()
    kinds = (
        ("secret", m.rlike(_whole(ASSIGNED)), _assigned),
        ("secret", m.rlike(_whole(ACCESS_KEY)), _access_key),
        ("secret", m.rlike(_whole(HEX)), _hex),
        ("email", m.contains("@"), _email),
        ("card", card & (_luhn(digits, 0) % 10 == 0), _card),
        ("ip", m.rlike(_whole(rf"{OCTET}(?:\.{OCTET}){{3}}")), _ip),
        ("date", date, _date),
        ("ssn", ssn, _ssn),
        ("phone", m.rlike(_whole(PHONE)), _phone),
    )
    out = F
    for kind, test, fn in kinds:
        out = out.when(test, F.struct(F.lit(kind).alias("kind"), fn(m, key).alias("value")))
    return out.otherwise(F.struct(F.lit(None).cast("string").alias("kind"), m.alias("value")))


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and n_card, n_phone, n_ssn, n_ip, n_date, n_email, n_secret.

    Each row is worked on by itself: nothing is shuffled. Cards must pass the Luhn check, addresses and dates must
    exist (dates from 1900 to 2100-02-19), social security numbers must be assignable; what is not valid stays. Null
    texts stay null and empty ones empty, with counts 0; columns of ``docs`` named like a count are replaced, and one
    named _matches is left out.
    """
    found = replace_columns(docs, _matches=F.when(F.col(text).rlike(HINT), F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0))))
    # The matches become pseudonyms in one projection and enter the text in the next, so that each is made once.
    made = replace_columns(found, _matches=F.transform(F.coalesce("_matches", F.array().cast("array<string>")), lambda m: _pseudonym(m, key)))
    values = F.concat(F.transform("_matches", lambda p: p["value"]), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(F.split(F.col(text), ANY, -1), values, lambda a, b: F.concat(a, b)), "")
    kinds = F.array_compact(F.transform("_matches", lambda p: p["kind"]))
    counts = {f"n_{k}": (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long") for k in KINDS}
    whole = replace_columns(made, **{text: F.when(F.size("_matches") > 0, joined).otherwise(F.col(text))}, **counts).drop("_matches")
    names = [c for c in docs.columns if c.lower() not in (*counts, "_matches")]
    return whole.select(*(f"`{c}`" for c in names), *counts)
