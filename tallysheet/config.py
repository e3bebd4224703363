"""Business rules as data. Operators take a ``Rules`` object; nothing is hard-wired in them."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SalesSource:
    """One voucher source: its header and body tables and the two constants stamped on its rows."""

    header: str
    body: str
    tipo_consumo: str
    db: str


@dataclass(frozen=True)
class BranchRule:
    """Points of sale, optionally limited to one deposit, that belong to a branch."""

    branch: str
    points_of_sale: tuple[int, ...]
    deposit: str | None = None


# They must equal the business definitions for results to agree.
SALES_SOURCES = (
    SalesSource("DIMDS_CABEZACOMPROBANTES", "DIMDS_CUERPOCOMPROBANTES", "DS", "DIMDS"),
    SalesSource("DIMPPAL_CABEZACOMPROBANTES", "DIMPPAL_CUERPOCOMPROBANTES", "PPAL", "DIMPPAL"),
    SalesSource("DISDS_CABEZACOMPROBANTES", "DISDS_CUERPOCOMPROBANTES", "DS", "DISDS"),
    SalesSource("DISPPAL_CABEZACOMPROBANTES", "DISPPAL_CUERPOCOMPROBANTES", "PPAL", "DISPPAL"),
)
VOUCHER_TYPES = ("FA", "FB", "NCA", "NCB", "NDA", "NDB", "RE")
EXCLUDED_ARTICLES = ("42537", "42538", "42357", "45436")
GM_VOUCHER_TYPE = "RE"
GM_POINTS_OF_SALE = (17, 18, 19, 109)
GM_DISCOUNT_PATTERN = r"^\s*\(([\d.]+)\)"
INVALID_SUPER_RUBROS = (-1, 377)
BRANCH_RULES = (
    BranchRule("BA", (19, 1)),
    BranchRule("BA", (8888,), "001"),
    BranchRule("MDP", (18, 7)),
    BranchRule("MDP", (2222,), "003"),
    BranchRule("PICO", (17, 6)),
    BranchRule("PICO", (2222,), "001"),
    BranchRule("ROSARIO", (109, 8)),
    BranchRule("ROSARIO", (8888,), "002"),
)
UNKNOWN_BRANCH = "UNKNOWN"
NO_SUPER_RUBRO = "SIN SUPERRUBRO"
METHOD_GM = "GM_DESCONTADO"
METHOD_SECONDARY = "SECUNDARIA_CERO"
METHOD_STANDARD = "PRECIO_ESTANDAR"
METHOD_LABELS = {
    METHOD_GM: "GM_DISCOUNTED",
    METHOD_SECONDARY: "SECONDARY_ZEROED",
    METHOD_STANDARD: "STANDARD_PRICE",
}
FIRST_MONTH = "2023-01"
PAGE_SIZE = 250


@dataclass(frozen=True)
class Rules:
    """Everything a caller may want to change without touching an operator."""

    sources: tuple[SalesSource, ...] = SALES_SOURCES
    voucher_types: tuple[str, ...] = VOUCHER_TYPES
    excluded_articles: tuple[str, ...] = EXCLUDED_ARTICLES
    gm_voucher_type: str = GM_VOUCHER_TYPE
    gm_points_of_sale: tuple[int, ...] = GM_POINTS_OF_SALE
    gm_discount_pattern: str = GM_DISCOUNT_PATTERN
    invalid_super_rubros: tuple[int, ...] = INVALID_SUPER_RUBROS
    branch_rules: tuple[BranchRule, ...] = BRANCH_RULES
    unknown_branch: str = UNKNOWN_BRANCH
    no_super_rubro: str = NO_SUPER_RUBRO
    method_labels: dict[str, str] = field(default_factory=lambda: dict(METHOD_LABELS))
    first_month: str = FIRST_MONTH
    # Dimensions whose tables have up to so many bytes are broadcast; larger ones take the shuffle join.
    broadcast_bytes: int = 64 << 20
    # Size of the table that voucher lines outside a load window are dropped by, in words of 8 bytes; it
    # works best with at least one word for every six vouchers of the window.
    key_filter_words: int = 1 << 17
    # How time is cut in the price lookup: a running window spans one article and one slice.
    price_slice: str = "day"


DEFAULT_RULES = Rules()
