"""Choice of one alternative per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.markup import flatten_wrappers, is_missing, reads_as_xhtml, structure_of
from lexspark.functions.text import let

# Word lists of the main text and of the annex.
MAIN_INCLUDE = ("ACT",)
MAIN_EXCLUDE = ("annexe", "annex", "cover", "erratum", "corrigendum")
ANNEX_INCLUDE = ("annex", "annexe")
ANNEX_EXCLUDE = ("ACT", "cover", "erratum", "corrigendum")
BONUS = 1000


def _any_word(name: Column, words: Sequence[str]) -> Column:
    test = F.lit(False)
    for word in words:
        test = test | F.contains(F.lower(name), F.lit(word.lower()))
    return test


def select_manifestation(
    items: DataFrame,
    key: str,
    include: Sequence[str] = MAIN_INCLUDE,
    exclude: Sequence[str] = MAIN_EXCLUDE,
) -> DataFrame:
    """Best listed item per document. Items with an exclude word are out; an
    include word gives a bonus once; the lowest order wins, then the first
    listed. When all items are out, the first listed item is taken.

    ``min_by`` combines before the shuffle, so a listing of any length costs
    one row per task."""
    name = F.col("stream_name")
    out = _any_word(name, exclude)
    score = F.when(out, F.lit(0)).otherwise(
        F.col("stream_order") - F.when(_any_word(name, include), F.lit(BONUS)).otherwise(F.lit(0))
    )
    rank = F.struct(out.cast("int").alias("out"), score.alias("score"), F.col("pos"))
    best = F.min_by(F.struct("url", "stream_name", "stream_order"), rank)
    return items.groupBy(key).agg(best.alias("_b")).select(key, "_b.*")


def select_annex(items: DataFrame, key: str) -> DataFrame:
    return select_manifestation(items, key, ANNEX_INCLUDE, ANNEX_EXCLUDE)


def body_mark(body: Column) -> Column:
    """Of several bodies of one (id, role, format) the usable one with the least mark counts."""
    return F.xxhash64(body)


def inspect_bodies(manifestations: DataFrame) -> DataFrame:
    """Narrow facts about every body, computed inside the row: is it readable,
    which page structure does it have, and a mark that tells bodies of one key
    apart. The body itself is left behind. Missing bodies have no row; plain
    HTML always counts as readable."""
    facts = lambda body: F.when(
        ~is_missing(body),
        F.array(F.struct(
            F.when(F.col("fmt") == "xhtml", reads_as_xhtml(body)).otherwise(True).alias("ok"),
            structure_of(flatten_wrappers(body)).alias("structure"),
            body_mark(body).alias("mark"),
        )),
    )
    # inline, not a filter: a filter would compute the facts a second time
    return manifestations.select("celex_id", "role", "fmt", F.inline(let(F.col("body"), facts)))


def body_choices(manifestations: DataFrame) -> DataFrame:
    """Both choices of a body per (id, role), in one pass over the bodies:

    * ``own``: (fmt, structure) of the XHTML when it is well-formed, or repaired so, and has
      a known structure, else of the plain HTML; NULL without a usable body. The
      structure may be NULL (plain HTML of unknown structure): such a body gives
      no units but counts as read.
    * ``lent``: the body another document borrows. It differs in one case: a
      well-formed XHTML without known structure stays chosen when there is no
      plain HTML, and then gives no units.
    """
    return marked_choices(manifestations).withColumns({
        c: F.when(F.col(c).isNotNull(), F.struct(f"{c}.fmt", f"{c}.structure")) for c in ("own", "lent")
    })


def marked_choices(manifestations: DataFrame) -> DataFrame:
    """``body_choices`` with the mark of each body."""
    plain = F.col("fmt") == "html"
    known = F.col("ok") & F.col("structure").isNotNull()
    pair = F.struct("fmt", "structure", "mark")
    own_rank = F.when(~plain & known, 0).when(plain, 1)
    lent_rank = F.when(~plain & known, 0).when(plain, 1).when(F.col("ok"), 2)
    first = lambda rank: F.min_by(pair, F.when(rank.isNotNull(), F.struct(rank.alias("rank"), "mark")))
    return inspect_bodies(manifestations).groupBy("celex_id", "role").agg(
        first(own_rank).alias("own"), first(lent_rank).alias("lent")
    )


def choose_body(manifestations: DataFrame) -> DataFrame:
    """One body per (id, role): rows celex_id, role, fmt, structure."""
    return body_choices(manifestations).filter(F.col("own").isNotNull()).select("celex_id", "role", "own.*")
