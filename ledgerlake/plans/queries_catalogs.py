"""The constant dimensions, whole, joined to supplied rows. Their values are written out again in the SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import dimensions, keys
from ledgerlake.plans.catalog import query


@query("parts_by_product", """
    select p.* exclude (sk), n.qtd from (
      select row_number() over (order by cod_produto) as sk, * from (values
      ('CORR_PF', 'Conta Corrente PF', 'Conta', 'Corrente', null, 'Baixo', 'Diária', false),
      ('CORR_PJ', 'Conta Corrente PJ', 'Conta', 'Corrente', null, 'Baixo', 'Diária', false),
      ('POUPP', 'Conta Poupança', 'Conta', 'Poupança', 'Poupança', 'Baixo', 'Diária', true),
      ('SALARIO', 'Conta Salário', 'Conta', 'Salário', null, 'Baixo', 'Diária', false),
      ('EMPREST_PESS', 'Empréstimo Pessoal', 'Crédito', 'Empréstimo', 'Prefixado', 'Médio', null, false),
      ('CONSIG', 'Crédito Consignado', 'Crédito', 'Consignado', 'Prefixado', 'Baixo', null, false),
      ('FINANC_AUTO', 'Financiamento Auto', 'Crédito', 'Financiamento', 'Prefixado', 'Médio', null, false),
      ('FINANC_IMOB', 'Financiamento Imobiliário', 'Crédito', 'Financiamento', 'IPCA+', 'Médio', null, false),
      ('LIMITE_CC', 'Limite Conta Corrente', 'Crédito', 'Cheque Especial', 'Prefixado', 'Alto', null, false),
      ('CDB_PRE', 'CDB Pré-fixado', 'Investimento', 'CDB', 'Prefixado', 'Baixo', 'No vencimento', true),
      ('CDB_CDI', 'CDB % CDI', 'Investimento', 'CDB', 'CDI', 'Baixo', 'D+1', true),
      ('LCI', 'LCI', 'Investimento', 'LCI', 'CDI', 'Baixo', 'No vencimento', true),
      ('LCA', 'LCA', 'Investimento', 'LCA', 'CDI', 'Baixo', 'No vencimento', true),
      ('FUNDO_RF', 'Fundo Renda Fixa', 'Investimento', 'Fundo', 'CDI', 'Baixo', 'D+1', false),
      ('FUNDO_MM', 'Fundo Multimercado', 'Investimento', 'Fundo', 'CDI', 'Médio', 'D+30', false),
      ('FUNDO_AV', 'Fundo de Ações', 'Investimento', 'Fundo', 'IBOV', 'Alto', 'D+30', false),
      ('TESOURO_S', 'Tesouro Selic', 'Investimento', 'Tesouro', 'Selic', 'Baixo', 'D+1', false),
      ('TESOURO_I', 'Tesouro IPCA+', 'Investimento', 'Tesouro', 'IPCA+', 'Baixo', 'No vencimento', false),
      ('PREV_PGBL', 'Previdência PGBL', 'Investimento', 'Previdência', 'CDI', 'Médio', 'D+5', false),
      ('ETF_BOVA', 'ETF BOVA11', 'Investimento', 'ETF', 'IBOV', 'Alto', 'Diária', false),
      ('SEG_VIDA', 'Seguro de Vida', 'Seguro', 'Vida', null, 'Baixo', null, false),
      ('SEG_AUTO', 'Seguro Auto', 'Seguro', 'Automóvel', null, 'Baixo', null, false),
      ('SEG_RESI', 'Seguro Residencial', 'Seguro', 'Residencial', null, 'Baixo', null, false),
      ('SEG_EMPR', 'Seguro Empresarial', 'Seguro', 'Empresarial', null, 'Baixo', null, false),
      ('CART_CRED_BASIC', 'Cartão Crédito Básico', 'Cartão', 'Crédito', null, 'Médio', null, false),
      ('CART_CRED_GOLD', 'Cartão Crédito Gold', 'Cartão', 'Crédito', null, 'Médio', null, false),
      ('CART_CRED_PLAT', 'Cartão Crédito Platinum', 'Cartão', 'Crédito', null, 'Médio', null, false),
      ('CART_DEB', 'Cartão Débito', 'Cartão', 'Débito', null, 'Baixo', null, false)
      ) v(cod_produto, nome_produto, categoria, subcategoria, indexador, risco, liquidez, garantia_fgc)
    ) p join (select p_partkey % 28 + 1 as sk, count(*) as qtd from part group by 1) n using (sk)""")
def parts_by_product(bank):
    """Every product of the catalog with its attributes; a part counts for the product its key falls on."""
    products = keys.small_surrogate_key(dimensions.dim_product(bank.spark), "cod_produto", "sk")
    counted = bank.table("part").groupBy((F.col("p_partkey") % 28 + 1).alias("sk")).agg(F.count("*").alias("qtd"))
    return products.join(counted, "sk").drop("sk")


@query("orders_by_channel", """
    select c.* exclude (sk), n.qtd from (
      select row_number() over (order by nome_canal) as sk, * from (values
      ('Pix', 'Digital', 'App/IB', true),
      ('TED', 'Digital', 'App/IB', true),
      ('DOC', 'Digital', 'App/IB', true),
      ('Compra Crédito', 'Digital', 'Cartão', true),
      ('Compra Débito', 'Digital', 'Cartão', true),
      ('Pagamento Boleto', 'Digital', 'App/IB', true),
      ('Saque', 'Presencial', 'ATM/Caixa', false),
      ('Depósito Espécie', 'Presencial', 'Caixa', false),
      ('Transferência CC', 'Digital', 'App/IB', true),
      ('Estorno', 'Digital', 'Sistema', true),
      ('IOF', 'Digital', 'Sistema', true),
      ('Tarifa', 'Digital', 'Sistema', true)
      ) v(nome_canal, tipo_canal, subtipo, eh_digital)
    ) c join (select o_orderkey % 12 + 1 as sk, count(*) as qtd from orders group by 1) n using (sk)""")
def orders_by_channel(bank):
    """Every channel of the seed; an order counts for the channel its key falls on."""
    channels = keys.small_surrogate_key(dimensions.dim_channel_seed(bank.spark), "nome_canal", "sk")
    counted = bank.table("orders").groupBy((F.col("o_orderkey") % 12 + 1).alias("sk")).agg(F.count("*").alias("qtd"))
    return channels.join(counted, "sk").drop("sk")


@query("orders_by_score", """
    select s.faixa_score, s.score_min, s.score_max, s.classificacao, s.risco, s.lo::double as taxa_min_mes, s.hi::double as taxa_max_mes,
           count(*) as qtd
    from orders join (values
      ('0-300', 0, 300, 'Muito Baixo', 'Alto', 0.0300, 0.3000),
      ('301-500', 301, 500, 'Baixo', 'Alto', 0.0200, 0.0300),
      ('501-700', 501, 700, 'Regular', 'Médio', 0.0100, 0.0200),
      ('701-850', 701, 850, 'Bom', 'Baixo', 0.0060, 0.0100),
      ('851-1000', 851, 1000, 'Excelente', 'Baixo', 0.0030, 0.0060)
    ) s(faixa_score, score_min, score_max, classificacao, risco, lo, hi) on o_orderkey * 37 % 1001 between s.score_min and s.score_max
    group by all""")
def orders_by_score(bank):
    """Every score class; an order's key gives a score from 0 to 1000."""
    scored = bank.table("orders").select((F.col("o_orderkey") * 37 % 1001).alias("score"))
    classes = [c for c in dimensions.dim_score(bank.spark).columns]
    return dimensions.with_score_class(scored, "score").groupBy(*classes).agg(F.count("*").alias("qtd"))
