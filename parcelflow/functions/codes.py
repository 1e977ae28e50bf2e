"""Administrative code expressions (all JVM-side Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def departement_of(code) -> Column:
    """Two leading characters, or three when they are the overseas prefix.

    NULL stays NULL (neither branch matches); a 1-char code gives itself.
    """
    c = _col(code)
    head = F.substring(c, 1, 2)
    return F.when(head != F.lit(S.OVERSEAS_PREFIX), head).when(
        head == F.lit(S.OVERSEAS_PREFIX), F.substring(c, 1, 3)
    )


def commune_of_parcelle(parcelle) -> Column:
    """Commune code = first five characters of a parcel id."""
    return F.substring(_col(parcelle), 1, 5)


def srid_of(departement, mode: str = "literal") -> Column:
    """EPSG code of the projection used for a département.

    ``literal`` reproduces the published CASE, where ``'000'`` (unlocated)
    falls in the default branch and gets 2154 because the exclusion list
    names ``'00'``; ``documented`` gives unlocated rows SRID 0 as the
    published comment intends.  ``'00'`` and NULL give NULL in both modes.
    """
    if mode not in ("literal", "documented"):
        raise ValueError("mode must be 'literal' or 'documented'")
    d = _col(departement)
    expr = None
    if mode == "documented":
        expr = F.when(d == F.lit(S.UNLOCATED_DEPARTEMENT), F.lit(S.SRID_UNLOCATED))
    first = ~d.isin(*S.SRID_EXCLUDED)
    expr = (expr.when(first, F.lit(S.SRID_DEFAULT)) if expr is not None
            else F.when(first, F.lit(S.SRID_DEFAULT)))
    for codes, srid in S.SRID_BY_DEPARTEMENT:
        expr = expr.when(d.isin(*codes), F.lit(srid))
    return expr.cast("int")


def departement_number(departement) -> Column:
    """Numeric département; NULL when not a number (never raises)."""
    return _col(departement).try_cast("int")


def lot_of(departement) -> Column:
    """Export batch of a département; NULL means the row is not routed."""
    d = _col(departement)
    n = departement_number(d)
    expr = F.when(d.isin(*S.CORSICA), F.lit(S.LOT_CORSICA))
    for bound, name in S.LOT_BOUNDS:
        expr = expr.when(n <= bound, F.lit(name))
    return expr.when(n > S.LOT_BOUNDS[-1][0], F.lit(S.LOT_OVERSEAS))


def type_prefix(type_objet) -> Column:
    """Leading characters of type_objet used as export sort key."""
    return F.substring(_col(type_objet), 1, S.TYPE_PREFIX_LEN)


def lot_of_commune(commune) -> Column:
    """Batch a commune code belongs to (used for partition pruning)."""
    return lot_of(departement_of(commune))


def routable(departement) -> Column:
    """True exactly when :func:`lot_of` is not NULL.

    Same truth table as ``lot_of(d).isNotNull()`` but references the
    département twice instead of once per batch bound, which keeps pushed
    down predicates small after Catalyst inlines the département expression.
    """
    d = _col(departement)
    return F.coalesce(d.isin(*S.CORSICA), F.lit(False)) | departement_number(d).isNotNull()
