"""Query of the URL filter. The learned verdict has no SQL form; tests hold the rest against brute force."""

from __future__ import annotations

from lexspark.llm.common import read
from lexspark.llm.queries import query
from lexspark.llm.url_filter import Rules, fit_filter, judge

RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


@query("op6_url_filters")
def op6(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    rules = Rules.of(RULES)
    return judge(pages, fit_filter(pages, rules))
