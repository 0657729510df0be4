"""Test rows of the on-time file."""

from __future__ import annotations

# Five well-known rows, fields joined by |.
VALID = (
    "12|1|12/2/2024 12:00:00 AM|AA|1234|JFK|New York, NY|NY|LAX|Los Angeles, CA|CA|0800|0815|15.00|"
    "1.00|1100|1125|25.00|1.00|0.00||2475.00|0.00|25.00|0.00|0.00|0.00"
).split("|")
CANCELLED = (
    "12|1|12/2/2024 12:00:00 AM|DL|5678|ORD|Chicago, IL|IL|ATL|Atlanta, GA|GA|0900||||1200||||"
    "1.00|B|600.00|||||"
).split("|")
SEVERE = (
    "12|3|12/3/2024 12:00:00 AM|UA|9999|BOS|Boston, MA|MA|SFO|San Francisco, CA|CA|0700|0710|10.00|"
    "0.00|1000|1250|170.00|1.00|0.00||2704.00|0.00|170.00|0.00|0.00|0.00"
).split("|")
WHITESPACE = [
    f" {field} "
    for field in (
        "12|1|12/2/2024 12:00:00 AM|UA|100|BOS|Boston, MA|MA|LAX|Los Angeles, CA|CA|0600|0605|5.00|"
        "0.00|0900|0910|10.00|0.00|0.00||2704.00|0.00|0.00|0.00|0.00|0.00"
    ).split("|")
]
NO_CAUSES = (
    "12|5|12/5/2024 12:00:00 AM|WN|200|DAL|Dallas, TX|TX|HOU|Houston, TX|TX|0700|0655|-5.00|0.00|"
    "0800|0750|-10.00|0.00|0.00||239.00|||||"
).split("|")


def line(fields: list[str], **changed: str) -> str:
    """One line of the file; fields with a comma are quoted. ``changed`` sets record fields."""
    from ontime_spark.schemas import RECORD_COLUMNS

    fields = list(fields)
    for name, text in changed.items():
        fields[RECORD_COLUMNS.index(name)] = text
    return ",".join(f'"{f}"' if "," in f else f for f in fields)
