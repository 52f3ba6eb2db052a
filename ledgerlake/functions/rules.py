"""Business classifications written as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.text import _col, folded

# Name fragments in order of precedence, and the channel each one means.
CHANNEL_WORDS = [
    ("pix", "Pix"),
    ("ted", "TED"),
    ("doc", "DOC"),
    ("credito", "Compra Credito"),
    ("debito", "Compra Debito"),
    ("saque", "Saque"),
    ("deposito", "Deposito Especie"),
    ("boleto", "Pagamento Boleto"),
]
OTHER_CHANNEL = "Outros"

# The second rule list, which names where the customer was served.
SERVICE_WORDS = [
    ("internet banking", "Internet Banking"),
    ("aplicativo", "Aplicativo Movel"),
    ("app", "Aplicativo Movel"),
    ("pix", "Aplicativo Movel"),
    ("caixa eletronico", "Caixa Eletronico"),
    ("atm", "Caixa Eletronico"),
    ("agencia", "Agencia"),
    ("telefone", "Central Telefonica"),
    ("debito automatico", "Debito Automatico"),
    ("ted", "Internet Banking"),
]

# Channel families, for each of the two lists.
CHANNEL_FAMILIES = {
    "Transferencia": ("Pix", "TED", "DOC"),
    "Cartao": ("Compra Credito", "Compra Debito"),
    "Caixa": ("Saque", "Deposito Especie"),
    "Boleto": ("Pagamento Boleto",),
}
SERVICE_FAMILIES = {
    "Digital": ("Internet Banking", "Aplicativo Movel"),
    "Autoatendimento": ("Caixa Eletronico",),
    "Presencial": ("Agencia",),
    "Remoto": ("Central Telefonica",),
}

# States by region. A code outside the list counts as Sudeste.
STATES = {
    "Norte": ("AC", "AM", "AP", "PA", "RO", "RR", "TO"),
    "Nordeste": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Centro-Oeste": ("DF", "GO", "MS", "MT"),
    "Sudeste": ("ES", "MG", "RJ", "SP"),
    "Sul": ("PR", "RS", "SC"),
}
DEFAULT_REGION = "Sudeste"
REGION_CODES = {"N": "Norte", "NE": "Nordeste", "SE": "Sudeste", "S": "Sul", "CO": "Centro-Oeste"}

# Fixed values: (lowest, highest, label) of each band.
AGE_BANDS = [
    (18, 24, "18-24"),
    (25, 34, "25-34"),
    (35, 44, "35-44"),
    (45, 54, "45-54"),
    (55, 64, "55-64"),
    (65, None, "65+"),
]
SCORE_BANDS = [
    (0, 300, "Muito Baixo"),
    (301, 500, "Baixo"),
    (501, 700, "Regular"),
    (701, 850, "Bom"),
    (851, 1000, "Excelente"),
]

# Fixed values: (bound, label); a value below the bound takes the label.
INCOME_STEPS = [(2000, "<2k"), (5000, "2-5k"), (10000, "5-10k"), (20000, "10-20k")]
TOP_INCOME = ">20k"
GDP_STEPS = [(10000, "<10k"), (25000, "10-25k"), (50000, "25-50k")]
TOP_GDP = ">50k"

# Fixed values: (last day of arrears, label).
ARREARS_STEPS = [(30, "0-30"), (60, "31-60"), (90, "61-90")]
LAST_ARREARS = "90+"
RISK_STEPS = [(180, "Crítico"), (90, "Alto"), (30, "Médio")]
LOWEST_RISK = "Baixo"


def _chain(pairs: Sequence[tuple[Column, str]], default: str | None) -> Column:
    expression = F
    for condition, label in pairs:
        expression = expression.when(condition, F.lit(label))
    return expression.otherwise(F.lit(default))


def first_match(
    name: Column | str, words: Sequence[tuple[str, str]], default: str = OTHER_CHANNEL
) -> Column:
    """Label of the first fragment found in the name, ignoring case but not accents."""
    lowered = F.lower(_col(name))
    return _chain([(lowered.contains(word), label) for word, label in words], default)


def folded_match(
    name: Column | str, words: Sequence[tuple[str, str]], default: str = OTHER_CHANNEL
) -> Column:
    """As `first_match`, but accents are ignored too: "Crédito" holds "credito"."""
    text = folded(name)
    return _chain([(text.contains(F.lit(word)), label) for word, label in words], default)


def channel_of(name: Column | str) -> Column:
    return first_match(name, CHANNEL_WORDS)


def folded_channel_of(name: Column | str) -> Column:
    return folded_match(name, CHANNEL_WORDS)


def service_channel_of(name: Column | str) -> Column:
    return first_match(name, SERVICE_WORDS)


def family_of(value: Column | str, families: dict[str, tuple[str, ...]], default: str) -> Column:
    return _chain([(_col(value).isin(*members), name) for name, members in families.items()], default)


def channel_family(channel: Column | str) -> Column:
    return family_of(channel, CHANNEL_FAMILIES, "Digital")


def service_family(channel: Column | str) -> Column:
    return family_of(channel, SERVICE_FAMILIES, "Automatico")


def region_of(state: Column | str) -> Column:
    return family_of(F.upper(_col(state)), STATES, DEFAULT_REGION)


def region_by_code(code: Column | str) -> Column:
    """Region name for its short code; an unknown code is kept as it is."""
    code = _col(code)
    return F.coalesce(_chain([(code == k, v) for k, v in REGION_CODES.items()], None), code)


def band(
    value: Column | str,
    bands: Sequence[tuple[float, float | None, str]],
    default: str | None,
) -> Column:
    value = _col(value)
    return _chain(
        [
            ((value >= low) if high is None else value.between(low, high), label)
            for low, high, label in bands
        ],
        default,
    )


def steps(value: Column | str, bounds: Sequence[tuple[float, str]], top: str) -> Column:
    return _chain([(_col(value) < bound, label) for bound, label in bounds], top)


def age_band(age: Column | str, below: str = "Menor") -> Column:
    return band(age, AGE_BANDS, below)


def age_band_by_days(birth: Column | str, as_of: Column) -> Column:
    """The rougher rule: elapsed days over 365.25, with no band below 18."""
    years = F.datediff(as_of, _col(birth)) / F.lit(365.25)
    bounds = [(high + 1, label) for _, high, label in AGE_BANDS if high is not None]
    return steps(years, bounds, AGE_BANDS[-1][2])


def score_band(score: Column | str) -> Column:
    return band(score, SCORE_BANDS, "Inválido")


def income_band(income: Column | str) -> Column:
    return steps(income, INCOME_STEPS, TOP_INCOME)


def gdp_band(gdp_per_head: Column | str) -> Column:
    return steps(gdp_per_head, GDP_STEPS, TOP_GDP)


def arrears_bucket(days: Column | str) -> Column:
    return _chain([(_col(days) <= last, label) for last, label in ARREARS_STEPS], LAST_ARREARS)


def risk_grade(days: Column | str) -> Column:
    return _chain([(_col(days) > floor, label) for floor, label in RISK_STEPS], LOWEST_RISK)
