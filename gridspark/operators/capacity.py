"""Installed-capacity aggregates, treemaps and registry look-ups.

The aggregates first reduce the fact to (UF, source) cells. That step combines
on the map side, so a dominant state or source costs nothing extra, and every
coarser level is rolled up from the few cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.operators.rowsets import first_rows

_MW_EXACT = "decimal(18,6)"


def table_stats(spark, tables: dict[str, DataFrame | None]) -> DataFrame:
    """Rows per table; a missing table (None) has NULL rows."""
    parts = [
        (spark.range(1) if df is None else df).agg(
            F.lit(name).alias("tabela"),
            (F.max(F.lit(None).cast("bigint")) if df is None else F.count("*")).alias("linhas"),
        )
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _filled(name: str) -> Column:
    return F.col(name) != ""


def totals_by_uf(fact: DataFrame) -> DataFrame:
    """Units per UF, most first."""
    return (
        fact.filter(_filled("siguf"))
        .groupBy("siguf")
        .agg(F.count("*").alias("total"))
        .orderBy(F.desc("total"), "siguf")
    )


def totals_by_source(fact: DataFrame) -> DataFrame:
    """Units and kW per source, most units first."""
    return (
        fact.filter(_filled("dscfontegeracao"))
        .groupBy(F.col("dscfontegeracao").alias("fonte"))
        .agg(
            F.count("*").alias("empreendimentos"),
            F.sum("potencia_instalada_kw").alias("potencia_total_kw"),
        )
        .orderBy(F.desc("empreendimentos"), "fonte")
    )


def connected_on(fact: DataFrame) -> Column:
    """Connection date of a unit: the typed column of a stored fact, which prunes, or the text."""
    return F.col("dia_conexao") if "dia_conexao" in fact.columns else F.col("data_conexao").try_cast("date")


def capacity_series(
    fact: DataFrame, uf: str | None, start: str, end: str, source: str | None = None
) -> DataFrame:
    """kW connected per month within [start, end]; all UFs when ``uf`` is None."""
    day = connected_on(fact)
    rows = fact.filter(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if uf:
        rows = rows.filter(F.col("siguf") == uf)
    if source:
        rows = rows.filter(F.col("dscfontegeracao") == source.lower())
    keys = [F.date_format(day, "yyyy-MM").alias("mes")]
    if not uf:
        keys.insert(0, F.col("siguf"))
    return rows.groupBy(*keys).agg(F.sum("potencia_instalada_kw").alias("potencia_kw"))


def capacity_cells(fact: DataFrame) -> DataFrame:
    """kW and units per (UF, source): the pre-aggregate behind every treemap."""
    return fact.groupBy("siguf", "dscfontegeracao").agg(
        F.sum("potencia_instalada_kw").alias("potencia_total_kw"),
        F.count("*").alias("empreendimentos"),
    )


CELL_DELTAS = "siguf string, dscfontegeracao string, kw decimal(38,6), unidades bigint"
_KW_EXACT = "decimal(28,6)"


def summed_deltas(deltas: DataFrame) -> DataFrame:
    """Signed changes of cells added up; cells without units and kW go."""
    return (
        deltas.groupBy("siguf", "dscfontegeracao")
        .agg(F.sum("kw").cast("decimal(38,6)").alias("kw"), F.sum("unidades").alias("unidades"))
        .filter((F.col("unidades") != 0) | (F.col("kw") != 0))
    )


def cell_deltas(added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """What rows put in and taken out change in the cells, exactly: kW are decimals of six places."""

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        kw = F.coalesce(F.col("potencia_instalada_kw").try_cast(_KW_EXACT), F.lit(0).cast(_KW_EXACT))
        return rows.select(
            "siguf", "dscfontegeracao", (kw * sign).cast(_KW_EXACT).alias("kw"), F.lit(sign).cast("bigint").alias("unidades")
        )

    both = signed(added, 1) if removed is None else signed(added, 1).unionByName(signed(removed, -1))
    return summed_deltas(both)


def cells_of(deltas: DataFrame) -> DataFrame:
    """The cells that a series of changes adds up to, as ``capacity_cells`` gives them."""
    return summed_deltas(deltas).filter(F.col("unidades") != 0).select(
        "siguf",
        "dscfontegeracao",
        F.col("kw").cast("double").alias("potencia_total_kw"),
        F.col("unidades").alias("empreendimentos"),
    )


def treemap_levels(cells: DataFrame) -> DataFrame:
    """The three treemap levels from the cells, in one roll-up.

    A level drops rows with an empty key of its own only: a unit without a UF
    still counts for its source.
    """
    rolled = cells.groupingSets(
        [["dscfontegeracao"], ["siguf"], ["siguf", "dscfontegeracao"]],
        "siguf",
        "dscfontegeracao",
    ).agg(
        F.grouping_id().alias("g"),
        F.sum("potencia_total_kw").alias("valor_kw"),
        F.sum("empreendimentos").alias("empreendimentos"),
    )
    # grouping_id bits: siguf is the high one, a set bit means "not a key here"
    level = F.when(F.col("g") == 2, "fonte").when(F.col("g") == 1, "uf").otherwise("uf_fonte")
    uf_ok = (F.col("g") == 2) | _filled("siguf")
    source_ok = (F.col("g") == 1) | _filled("dscfontegeracao")
    return rolled.filter(uf_ok & source_ok).select(
        level.alias("nivel"),
        F.col("siguf").alias("uf"),
        F.col("dscfontegeracao").alias("fonte"),
        "valor_kw",
        "empreendimentos",
    )


def treemap(cells: DataFrame, level: str = "uf_fonte") -> DataFrame:
    """One treemap level, largest first."""
    keys = {"fonte": ["dscfontegeracao"], "uf": ["siguf"]}.get(
        level, ["siguf", "dscfontegeracao"]
    )
    names = {"siguf": "uf", "dscfontegeracao": "fonte"}
    rows = cells
    for key in keys:
        rows = rows.filter(_filled(key))
    return (
        rows.groupBy(*[F.col(k).alias(names[k]) for k in keys])
        .agg(
            F.sum("potencia_total_kw").alias("valor_kw"),
            F.sum("empreendimentos").alias("empreendimentos"),
        )
        .orderBy(F.desc("valor_kw"), *[names[k] for k in keys])
    )


def treemap_tree(cells: DataFrame) -> DataFrame:
    """One row per UF with its sources nested, largest first inside.

    A group holds one entry per source of the UF, never one per unit.
    """
    leaf = F.struct(
        (-F.coalesce("potencia_total_kw", F.lit(0.0))).alias("order"),
        F.col("dscfontegeracao").alias("name"),
        F.coalesce("potencia_total_kw", F.lit(0.0)).alias("value"),
        "empreendimentos",
    )
    return (
        cells.filter(_filled("siguf") & _filled("dscfontegeracao"))
        .groupBy(F.col("siguf").alias("name"))
        .agg(
            F.sum(F.coalesce("potencia_total_kw", F.lit(0.0))).alias("value"),
            F.sort_array(F.collect_list(leaf)).alias("leaves"),
        )
        .select(
            "name",
            "value",
            F.transform(
                "leaves",
                lambda x: F.struct(
                    x["name"].alias("name"),
                    x["value"].alias("value"),
                    x["empreendimentos"].alias("empreendimentos"),
                ),
            ).alias("children"),
        )
        .orderBy(F.desc("value"), "name")
    )


def combined_cells(fact: DataFrame, plants: DataFrame) -> DataFrame:
    """Cells of distributed plus central capacity; source labels stay as they are."""
    central = (
        plants.filter(_filled("uf") & _filled("tipo_geracao"))
        .groupBy(F.col("uf").alias("siguf"), F.col("tipo_geracao").alias("dscfontegeracao"))
        .agg(
            F.sum("potencia_outorgada_kw").alias("potencia_total_kw"),
            F.count("*").alias("empreendimentos"),
        )
    )
    local = capacity_cells(fact.filter(_filled("siguf") & _filled("dscfontegeracao")))
    return (
        local.unionByName(central)
        .groupBy("siguf", "dscfontegeracao")
        .agg(
            F.sum("potencia_total_kw").alias("potencia_total_kw"),
            F.sum("empreendimentos").alias("empreendimentos"),
        )
    )


def capacity_combined(fact: DataFrame, plants: DataFrame) -> DataFrame:
    """Combined treemap levels in MW."""
    return treemap_levels(combined_cells(fact, plants)).withColumn(
        "potencia_mw", F.col("valor_kw") / 1000
    ).drop("valor_kw")


def _audited_cells(classified: DataFrame) -> DataFrame:
    """Units and exact kW per (UF, source code), outliers left out.

    Decimals make the sum independent of the order rows arrive in, which keeps
    the third decimal of the MW totals stable between runs. The outlier test
    sits in the aggregates, so its rules are evaluated once per row and not
    again in a filter pushed below them.
    """
    counted = F.col("is_outlier") == 0
    return (
        classified.groupBy("uf", "fonte_norm")
        .agg(
            F.count(F.when(counted, 1)).alias("qtd"),
            F.sum(F.when(counted, F.col("potencia_kw").cast(_MW_EXACT))).alias("kw"),
        )
        .filter(F.col("qtd") > 0)
    )


def _mw(kw: Column) -> Column:
    thousandth = F.lit("0.001").cast("decimal(4,3)")
    return F.round(kw.cast("decimal(28,6)") * thousandth, 3).cast("double")


def _totals(cells: DataFrame, *keys: str) -> DataFrame:
    return cells.groupBy(*keys).agg(
        F.sum("qtd").alias("qtd_empreendimentos"), _mw(F.sum("kw")).alias("potencia_total_mw")
    )


def totals_uf_view(classified: DataFrame) -> DataFrame:
    return _totals(_audited_cells(classified), "uf")


def totals_source_view(classified: DataFrame) -> DataFrame:
    return _totals(_audited_cells(classified), "fonte_norm")


def totals_uf_source_view(classified: DataFrame) -> DataFrame:
    return _totals(_audited_cells(classified), "uf", "fonte_norm")


def totals_views(classified: DataFrame) -> DataFrame:
    """The three totals views in one pass, told apart by ``visao``."""
    rolled = _audited_cells(classified).groupingSets(
        [["uf"], ["fonte_norm"], ["uf", "fonte_norm"]], "uf", "fonte_norm"
    ).agg(
        F.grouping_id().alias("g"),
        F.sum("qtd").alias("qtd_empreendimentos"),
        _mw(F.sum("kw")).alias("potencia_total_mw"),
    )
    view = F.when(F.col("g") == 1, "uf").when(F.col("g") == 2, "fonte").otherwise("uf_fonte")
    return rolled.select(
        view.alias("visao"), "uf", "fonte_norm", "qtd_empreendimentos", "potencia_total_mw"
    )


def totals_summary(classified: DataFrame) -> DataFrame:
    """Grand total, per source and per UF, in one pass; the grand total exists for no rows too."""
    cells = _audited_cells(classified)
    # A cell of nothing: without rows there is still a grand total, and no other group counts it.
    nothing = classified.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("uf"),
        F.lit(None).cast("string").alias("fonte_norm"),
        F.lit(0).cast("bigint").alias("qtd"),
        F.lit(0).cast("decimal(28,6)").alias("kw"),
    )
    rolled = cells.unionByName(nothing).groupingSets([["uf"], ["fonte_norm"], []], "uf", "fonte_norm").agg(
        F.grouping_id().alias("g"), F.sum("qtd").alias("qtd"), F.coalesce(_mw(F.sum("kw")), F.lit(0.0)).alias("mw")
    )
    g = F.col("g")
    return rolled.filter((F.col("qtd") > 0) | (g == 3)).select(
        F.when(g == 1, "uf").when(g == 2, "fonte").otherwise("total").alias("nivel"),
        F.when(g == 1, F.col("uf")).when(g == 2, F.col("fonte_norm")).alias("chave"),
        "qtd",
        "mw",
    )


def export_tree(classified: DataFrame) -> DataFrame:
    """One row per UF for the MW treemap file, in one pass.

    Sources without positive MW are left out, and so are UFs left without any;
    the UF keeps all its MW.
    """
    mw = _mw(F.col("kw"))
    leaf = F.struct(
        (-mw).alias("order"), F.col("fonte_norm").alias("name"), mw.alias("value"), F.col("qtd").alias("qtd")
    )
    cells = _audited_cells(classified).filter(_filled("uf"))
    return (
        cells.groupBy("uf")
        .agg(
            _mw(F.sum("kw")).alias("value"),
            F.sum("qtd").alias("qtd"),
            # One leaf for each source code: a handful.
            F.sort_array(F.collect_list(F.when(mw > 0, leaf))).alias("leaves"),
        )
        .filter(F.size("leaves") > 0)
        .select(
            F.col("uf").alias("name"),
            "value",
            "qtd",
            F.transform(
                "leaves",
                lambda x: F.struct(
                    x["name"].alias("name"),
                    x["value"].alias("value"),
                    x["qtd"].alias("qtd"),
                    x["name"].alias("fonte"),
                ),
            ).alias("children"),
        )
    )


def units_page(
    fact: DataFrame,
    uf: str | None = None,
    source_like: str | None = None,
    limit: int | None = 100,
    offset: int = 0,
) -> DataFrame:
    """Units by id, optionally of one UF or with a source text; all of them without a limit."""
    rows = fact
    if uf:
        rows = rows.filter(F.col("siguf") == uf.upper())
    if source_like:
        rows = rows.filter(F.col("dscfontegeracao").ilike(f"%{source_like}%"))
    page = first_rows(rows.orderBy("id").offset(offset), limit)
    return page.select("id", "cod_empreendimento", "siguf", "dscfontegeracao", "potencia_instalada_kw")


def _top_columns(df: DataFrame, kind: str) -> DataFrame:
    names = {
        "mmgd": ("siguf", "cod_empreendimento", "potencia_instalada_kw", "dscfontegeracao"),
        "siga": ("uf", "nome_empreendimento", "potencia_outorgada_kw", "tipo_geracao"),
    }[kind]
    return df.select(*[F.col(c).alias(n) for c, n in zip(names, ["uf", "name", "value", "fonte"])])


def treemap_uf(df: DataFrame, uf: str, kind: str = "siga", limit: int | None = 100) -> DataFrame:
    """Largest plants (``siga``) or units (``mmgd``) of one UF."""
    rows = _top_columns(df, kind).filter(F.col("uf") == uf.upper())
    return first_rows(rows.orderBy(F.desc("value"), "name"), limit)


def treemap_every_uf(df: DataFrame, kind: str = "siga", limit: int = 100) -> DataFrame:
    """Largest plants or units of each UF, with their rank.

    The rank filter becomes a group limit ahead of the shuffle, so each task
    sends at most ``limit`` rows per UF.
    """
    order = Window.partitionBy("uf").orderBy(F.desc("value"), "name")
    rows = _top_columns(df, kind).filter(_filled("uf"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= limit
    )
