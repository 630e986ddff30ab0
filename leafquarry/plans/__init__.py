"""Registered queries of the core: every module of this package has QUERIES and SQL dictionaries."""

from importlib import import_module
from pkgutil import iter_modules

# Integer columns whose type in the oracle differs from the query's: name of the query, columns, type there.
ORACLE_TYPES = [
    ("INTEGER", {
        "v07_adjacent": ("heading_after_heading", "page_footers", "wide_gaps"), "v10_chunk_validator": ("assets", "ids"), "d04_mixed_order": ("seq",),
        "g16_argmax": ("n",), "t01_reading_sort": ("n",), "t03_longest_first": ("n",), "e03_shared_words": ("shared",), "c40_dual_prose": ("line_no",),
        "v18_first_difference": ("at",), "c18_heading_depth": ("result",), "g04_measurable_chars": ("result",),
        "c35_first_match_line": ("result",), "c28_header_variants": ("result",), "s06_text_lines": ("line_no",),
        "s07_whole_texts": ("bytes",), "s08_json_sidecars": ("n_levels",), "w06_column_order": ("reading_no",), "w11_span_roles": ("page",),
        "w17_first_rows": ("line_no",), "w24_context": ("line_no",), "j05_as_of_backward": ("line_no",), "j06_as_of_forward": ("line_no",),
    }),
    ("BIGINT", {
        "v01_reading_coverage": ("expected", "found"), "v02_page_coverage": ("chars",), "f02_rotation": ("n_rotated",), "g10_summary": ("passed", "failed"),
        "g11_rollup": ("chars", "blank"), "g18_registry_completeness": ("without_tiers",), "c38_figure_injection": ("n_lines",),
        "w03_gap_paragraphs": ("paragraph",), "w14_join_wrapped": ("block_no",), "w24_context": ("chars_in",),
    }),
]


def registered() -> tuple[dict, dict]:
    """Queries and oracle SQL of all modules of this package."""
    queries, sql = {}, {}
    for found in sorted(iter_modules(__path__), key=lambda m: m.name):
        module = import_module(f"{__name__}.{found.name}")
        queries |= module.QUERIES
        sql |= module.SQL
    for kind, columns in ORACLE_TYPES:
        for name, cols in columns.items():
            casts = ", ".join(f'CAST("{c}" AS {kind}) AS "{c}"' for c in cols)
            sql[name] = f"SELECT * REPLACE ({casts}) FROM ({sql[name]})"
    return queries, sql
