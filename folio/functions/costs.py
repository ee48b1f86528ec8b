"""Token and cost arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Dollars for a thousand tokens in and out; working hours and days of a month.
PRICE_IN, PRICE_OUT = 0.00135, 0.0054
HOURS, DAYS = 8, 30
#: Expected characters of a field's value by its name.
VALUE_CHARS = {
    "patient name": 43,
    "date of birth": 12,
    "provider name": 40,
    "provider address": 50,
    "medications": 50,
    "principal diagnosis": 40,
    "pat's hi claim": 20,
    "sex": 5,
    "name": 43,
    "dob": 12,
    "mrn": 20,
    "acc_num": 20,
    "admit_date": 12,
    "discharge_date": 12,
}
OTHER_CHARS, SCORE_CHARS = 50, 3
CHARS_PER_TOKEN, SPARE = 3.5, 1.10


def token_cost(tokens_in: Column, tokens_out: Column, price_in: float = PRICE_IN, price_out: float = PRICE_OUT) -> Column:
    return tokens_in / 1000 * price_in + tokens_out / 1000 * price_out


def monthly_requests(per_second: Column, hours: int = HOURS, days: int = DAYS) -> Column:
    return per_second * 3600 * hours * days


def monthly_cost(tokens_in: Column, tokens_out: Column, per_second: Column, price_in: float = PRICE_IN, price_out: float = PRICE_OUT) -> Column:
    requests = monthly_requests(per_second)
    return requests * tokens_in / 1_000_000 * price_in * 1000 + requests * tokens_out / 1_000_000 * price_out * 1000


def european(x: Column, places: int = 2) -> Column:
    """Thousands by points and decimals behind a comma."""
    return F.translate(F.format_number(x, places), ",.", ".,")


def value_chars(key: Column) -> Column:
    """Expected characters of the value of a key; keys of confidences are short."""
    low = F.lower(key)
    out = F.when(low.endswith("_s"), SCORE_CHARS)
    for name, chars in VALUE_CHARS.items():
        out = out.when(low == name, chars)
    return out.otherwise(OTHER_CHARS)


def response_tokens(n_keys: Column, key_chars: Column, chars: Column) -> Column:
    """Tokens to allow for an answer: structure, values and keys (with one confidence key each), and some to spare."""
    structure = F.lit(4) + n_keys * 10 - 1
    return F.floor((structure + chars / CHARS_PER_TOKEN + key_chars / CHARS_PER_TOKEN) * SPARE).cast("long")
