"""The whole build: raw text tables to clean tables, dimensions, facts and marts.

Each layer is written and read back, as a warehouse would: the written table
cuts the lineage, survives lost executors, and gives the next layer real sizes
to plan with. Independent tables are written side by side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import REFERENCE_DAY
from ledgerlake.functions.rules import AGE_BANDS
from ledgerlake.operators import cleaning, dimensions, facts, marts
from ledgerlake.operators.keys import small_surrogate_key
from ledgerlake.sources.readers import with_stamp
from ledgerlake.sources.writers import laid_out, overwrite, publish_view

# The columns that hold the time a clean or final table was written.
SILVER_STAMP, GOLD_STAMP = "_silver_ts", "_carga_ts"

Tables = Mapping[str, DataFrame]
Makers = dict[str, Callable[[], DataFrame]]


class StoredTables(Mapping):
    """Tables of one layer, each written when first asked for and read back from then on.

    Makers of `partitioned` tables deal their rows by `laid_out` themselves.

    A stored table cuts the lineage, survives lost executors, and gives the next
    layer real sizes to plan with.
    """

    def __init__(self, makers: Makers, root: str, partitioned: dict[str, list[str]] | None = None):
        self._makers, self._root, self._partitioned = makers, root, partitioned or {}
        self._stored: dict[str, DataFrame] = {}
        self._locks = {name: Lock() for name in makers}

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._stored:
                self._stored[name] = overwrite(
                    self._makers[name](), f"{self._root}/{name}", self._partitioned.get(name, ()), placed=True
                )
            return self._stored[name]

    def plan(self, name: str) -> DataFrame:
        """The stored copy if there is one, else the table as a plan, which is not stored for that."""
        return self._stored[name] if name in self._stored else self._makers[name]()

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def build(self, workers: int = 8) -> StoredTables:
        """Write every table, several at a time; one that needs another waits for it."""
        with ThreadPoolExecutor(max_workers=workers) as pool:
            list(pool.map(self.__getitem__, self._makers))
        return self


class Plans(Mapping):
    """The tables of a layer for readers that read each once: what is not stored yet is planned, not written first."""

    def __init__(self, tables: StoredTables):
        self._tables = tables

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables.plan(name)

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


def silver(raw: Tables, as_of: dt.date = REFERENCE_DAY) -> Makers:
    """How to make each clean table; nothing is planned until one is called."""
    return {
        "clientes": lambda: cleaning.clean_clients(raw["clientes"], as_of),
        "clientes_sinteticos": lambda: cleaning.clean_synthetic_clients(raw["clientes_sinteticos"]),
        "contas": lambda: cleaning.clean_accounts(raw["contas"]),
        "transacoes": lambda: cleaning.clean_transactions(raw["transacoes"]),
        "agencias": lambda: cleaning.clean_branches(raw["agencias"], raw["agencias_expandidas"]),
        "colaboradores": lambda: cleaning.clean_staff(raw["colaboradores_expandidos"], raw["colaboradores"]),
        "propostas": lambda: cleaning.clean_proposals(raw["propostas_credito"], raw["propostas_sinteticas"]),
        "ipca": lambda: cleaning.clean_ipca(raw["ipca"], raw["ipca_projetado"]),
        "selic": lambda: cleaning.clean_selic(raw["selic"], raw["selic_projetada"]),
        "municipios": lambda: cleaning.clean_municipalities(
            raw["municipios"], raw["populacao"], raw["pib_municipal"]
        ),
        **{name: (lambda name=name: cleaning.clean_product_source(raw[name], name)) for name in cleaning.PRODUCT_KINDS if name in set(raw)},
    }


def enriched_calendar(cal: DataFrame, raw: Tables) -> DataFrame:
    cal = dimensions.with_daily(cal, raw["selic"], "taxa_selic", "taxa_selic")
    cal = dimensions.with_daily(cal, raw["cdi"], "taxa_cdi", "taxa_cdi")
    cal = dimensions.with_daily(cal, raw["dolar_ptax"], "cotacao_media", "cotacao_dolar")
    cal = dimensions.with_daily(cal, raw["euro_ptax"], "cotacao_media", "cotacao_euro")
    cal = dimensions.with_monthly(
        cal, raw["ipca"], {"indice": "indice_ipca", "no_mes": "ipca_mes", "acumulado_12m": "ipca_acum_12m"}
    )
    return dimensions.with_holidays(cal, raw["feriados"])


def _stamped(makers: Makers, stamp: str) -> Makers:
    return {name: (lambda make=make: with_stamp(make(), stamp)) for name, make in makers.items()}


def silver_layer(raw: Tables, root: str, as_of: dt.date = REFERENCE_DAY) -> StoredTables:
    return StoredTables(_stamped(silver(raw, as_of), SILVER_STAMP), f"{root}/silver")


def gold_layer(
    raw: Tables,
    clean: Tables,
    cal: Callable[[], DataFrame],
    root: str,
    as_of: dt.date = REFERENCE_DAY,
    all_active: bool = True,
    partition_facts: bool = True,
) -> StoredTables:
    """Dimensions and facts. The transaction fact is laid out by month, for partition pruning."""

    def c(name: str) -> DataFrame:
        return clean[name].drop(SILVER_STAMP)

    def g(name: str) -> DataFrame:
        return layer[name].drop(GOLD_STAMP)

    makers: Makers = {
        "dim_tempo": lambda: enriched_calendar(cal(), raw),
        "dim_municipio": lambda: dimensions.dim_municipality(
            raw["municipios"], raw["populacao"], raw["pib_municipal"]
        ),
        # Only names are read, so a clean table that nothing else has asked for is not written for them.
        "dim_canal": lambda: dimensions.dim_channel(
            (clean.plan("transacoes") if isinstance(clean, StoredTables) else clean["transacoes"]).drop(SILVER_STAMP)
        ),
        "dim_agencia": lambda: dimensions.link_municipality(
            dimensions.dim_branch(c("agencias")), g("dim_municipio")
        ),
        "dim_cliente": lambda: dimensions.link_municipality(
            dimensions.dim_client(c("clientes"), c("clientes_sinteticos")), g("dim_municipio")
        ),
        "dim_colaborador": lambda: dimensions.dim_staff(c("colaboradores"), g("dim_agencia")),
        "fato_transacoes": lambda: transactions(),
        "fato_contas": lambda: facts.fact_accounts(
            c("contas"), g("dim_tempo"), g("dim_cliente"), g("dim_agencia"), g("dim_colaborador"), as_of, all_active
        ),
        "fato_propostas_credito": lambda: facts.fact_proposals(
            raw["propostas_credito"], g("dim_tempo"), g("dim_cliente"), g("dim_colaborador")
        ),
    }
    makers["dim_produto"] = lambda: small_surrogate_key(dimensions.dim_product(cal().sparkSession), "cod_produto", "sk_produto")

    def transactions() -> DataFrame:
        """Dealt by month before measures and stamp are added, so that those are not moved."""
        found = facts.place_transactions(
            c("transacoes"), g("dim_tempo"), c("contas"), g("dim_cliente"), g("dim_agencia"), g("dim_canal")
        ).withColumn("ano_mes", _month_of_key(g("dim_tempo")))
        if partition_facts:
            rows = c("transacoes").count()  # read from the footers
            found = laid_out(found, ["ano_mes"], rows, ["cod_transacao"])
        return facts.transaction_measures(found)

    def product(name: str) -> DataFrame:
        """Only the dimensions that this fact has a key of are asked for, and so made."""
        _, has_product, has_branch, has_channel = facts.PRODUCT_FACTS[name]
        linked = (("dim_agencia", has_branch), ("dim_produto", has_product), ("dim_canal", has_channel))
        return facts.product_fact(
            c(name), name, g("dim_tempo"), g("dim_cliente"), *[g(dim) if used else None for dim, used in linked]
        )

    for name in sorted(set(facts.PRODUCT_FACTS) & set(clean)):
        makers[f"fato_{name}"] = lambda name=name: product(name)
    layer = StoredTables(_stamped(makers, GOLD_STAMP), f"{root}/gold", {"fato_transacoes": ["ano_mes"]} if partition_facts else {})
    return layer


def _month_of_key(cal: DataFrame):
    """Month label of a calendar key: keys count days from the calendar's first day."""
    first = cal.agg(F.min("data")).scalar()
    return F.date_format(F.date_add(first, F.col("sk_tempo") - 1), "yyyy-MM")


def mart_views(gold: Tables) -> Makers:
    """How to make each mart, as a plan over the stored facts."""

    def balances() -> DataFrame:
        return marts.balance_by_branch(gold["fato_contas"], gold["dim_agencia"])

    def volumes() -> DataFrame:
        codes = gold["dim_agencia"].select("sk_agencia", "cod_agencia")
        return marts.volume_by(gold["fato_transacoes"], ["sk_agencia"]).join(codes, "sk_agencia")

    return {
        "kpi1": balances,
        "kpi2_3": lambda: marts.mix_by_month(gold["fato_transacoes"], gold["dim_tempo"]),
        "kpi4": lambda: marts.share_by_status(gold["fato_propostas_credito"]),
        "kpi5": lambda: marts.branch_ranking(balances(), volumes()),
        "kpi6": lambda: marts.staff_portfolio(
            gold["dim_colaborador"], gold["dim_agencia"], gold["fato_contas"], gold["fato_propostas_credito"]
        ),
        "kpi7": lambda: marts.client_segments(gold["dim_cliente"], gold["fato_contas"]),
        "kpi8": lambda: marts.deflated_volume(gold["fato_transacoes"], gold["dim_tempo"]),
    }


# How each mart is ordered when it is shown.
REPORT_ORDER: dict[str, list[Callable[[], Column]]] = {
    "kpi1": [lambda: F.desc("saldo_total")],
    "kpi2_3": [lambda: F.asc("ano"), lambda: F.asc("mes"), lambda: F.desc("volume_total")],
    "kpi4": [lambda: F.desc("qtd_propostas")],
    "kpi5": [lambda: F.asc("ranking")],
    "kpi6": [lambda: F.desc_nulls_last("saldo_gerido"), lambda: F.asc("cod_colaborador")],
    "kpi7": [lambda: marts.band_order("faixa_etaria", [label for _, _, label in AGE_BANDS])],
    "kpi8": [lambda: F.asc("ano"), lambda: F.asc("mes")],
}


def report(gold: Tables, name: str, rows: int | None = None, where: str | None = None) -> DataFrame:
    """A mart in its usual order; `where` picks its rows, and `rows` keeps the top of those."""
    mart = mart_views(gold)[name]()
    ordered = (mart if where is None else mart.where(where)).orderBy(*[key() for key in REPORT_ORDER[name]])
    return ordered if rows is None else ordered.limit(rows)


def publish_marts(gold: Tables) -> None:
    """Every mart as a temporary view: mart_kpi1, mart_kpi2_3 and so on."""
    for name, make in mart_views(gold).items():
        publish_view(make(), f"mart_{name}")


def build_warehouse(
    raw: Tables,
    cal: Callable[[], DataFrame],
    root: str,
    as_of: dt.date = REFERENCE_DAY,
    all_active: bool = True,
) -> dict[str, DataFrame]:
    """Every layer, written under `root`, and the marts over it."""
    clean = silver_layer(raw, root, as_of).build()
    gold = gold_layer(raw, clean, cal, root, as_of, all_active).build()
    return {name: make() for name, make in mart_views(gold).items()}
