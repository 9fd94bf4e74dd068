from ledgerstrata.functions.scalars import (
    band,
    cagr_ratio,
    concept_label,
    growth_pct,
    pct,
    period_index,
    scaled,
    sic_division,
    statement_type,
)

__all__ = [
    "band",
    "cagr_ratio",
    "concept_label",
    "growth_pct",
    "pct",
    "period_index",
    "scaled",
    "sic_division",
    "statement_type",
]
