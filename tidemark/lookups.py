"""Seed tables and value groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# State code, state name, region.
STATES = [
    ("AC", "Acre", "North"),
    ("AL", "Alagoas", "Northeast"),
    ("AM", "Amazonas", "North"),
    ("AP", "Amapá", "North"),
    ("BA", "Bahia", "Northeast"),
    ("CE", "Ceará", "Northeast"),
    ("DF", "Distrito Federal", "Central-West"),
    ("ES", "Espírito Santo", "Southeast"),
    ("GO", "Goiás", "Central-West"),
    ("MA", "Maranhão", "Northeast"),
    ("MG", "Minas Gerais", "Southeast"),
    ("MS", "Mato Grosso do Sul", "Central-West"),
    ("MT", "Mato Grosso", "Central-West"),
    ("PA", "Pará", "North"),
    ("PB", "Paraíba", "Northeast"),
    ("PE", "Pernambuco", "Northeast"),
    ("PI", "Piauí", "Northeast"),
    ("PR", "Paraná", "South"),
    ("RJ", "Rio de Janeiro", "Southeast"),
    ("RN", "Rio Grande do Norte", "Northeast"),
    ("RO", "Rondônia", "North"),
    ("RR", "Roraima", "North"),
    ("RS", "Rio Grande do Sul", "South"),
    ("SC", "Santa Catarina", "South"),
    ("SE", "Sergipe", "Northeast"),
    ("SP", "São Paulo", "Southeast"),
    ("TO", "Tocantins", "North"),
]

# Category in Portuguese, category in English.
CATEGORIES = [
    ("beleza_saude", "Health & Beauty"),
    ("informatica_acessorios", "Computers & Accessories"),
    ("automotivo", "Auto"),
    ("cama_mesa_banho", "Bed Bath Table"),
    ("moveis_decoracao", "Furniture & Decor"),
    ("esporte_lazer", "Sports & Leisure"),
    ("perfumaria", "Perfumery"),
    ("utilidades_domesticas", "Housewares"),
    ("telefonia", "Telephony"),
    ("relogios_presentes", "Watches & Gifts"),
    ("alimentos_bebidas", "Food & Drink"),
    ("bebes", "Babies"),
    ("papelaria", "Stationery"),
    ("tablets_impressao_imagem", "Tablets Printing Image"),
    ("brinquedos", "Toys"),
    ("telefonia_fixa", "Fixed Telephony"),
    ("ferramentas_jardim", "Garden Tools"),
    ("fashion_bolsas_e_acessorios", "Fashion Bags & Accessories"),
    ("eletroportateis", "Small Appliances"),
    ("outros", "Others"),
]

# Order status and its group.
STATUS_GROUPS = {
    "delivered": "completed",
    "shipped": "active",
    "invoiced": "active",
    "processing": "active",
    "created": "active",
    "canceled": "cancelled",
    "unavailable": "cancelled",
}

# The allowed order statuses, in the order reports show them.
ORDER_STATUSES = ["delivered", "shipped", "canceled", "invoiced", "processing", "created", "unavailable"]

# Payment type and its group.
PAYMENT_GROUPS = {"credit_card": "card", "debit_card": "card", "boleto": "boleto", "voucher": "voucher"}

# Texts a CSV field may hold to say that it is empty.
CSV_NULL_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# The same for JSON and XML.
JSON_NULL_TEXTS = ["None", "nan"]
XML_NULL_TEXTS = ["None", ""]


def _values(spark: SparkSession, rows: list[tuple[str, ...]], columns: str) -> DataFrame:
    # A VALUES list is a relation of known size, so a join with it is broadcast by its size.
    quoted = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS t({columns})")


def state_lookup(spark: SparkSession) -> DataFrame:
    return _values(spark, STATES, "state_code, state_name, region")


def category_lookup(spark: SparkSession) -> DataFrame:
    return _values(spark, CATEGORIES, "category_pt, category_en")
