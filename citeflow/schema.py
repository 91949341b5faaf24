"""Types and closed domains of mentions, registry rows and verdicts."""

from __future__ import annotations

from pyspark.sql import types as T

# Decision paths and the class each one gives.
PATH_CLASS = {
    "sem_numero": "incompleta",
    "numero_ausente": "inventada",
    "numero_contradito": "inventada",
    "numero_unico": "real",
    "numero_desempatado": "real",
    "numero_ambiguo": "incompleta",
    "lei_apelido_desconhecido": "inventada",
    "lei_ausente": "inventada",
    "lei_unica": "real",
    "lei_ambigua": "incompleta",
    "referencia_vaga": "incompleta",
    "campos_nao_lidos": "incompleta",
}

# How specific a form is; the higher number wins an overlap.
FORM_RANK = {"com_numero": 3, "sumula": 2, "lei_artigo": 1, "sem_numero": 0, "referencia_vaga": -1}

# Case classes that are stages of one kind of case.
CLASS_FAMILIES = [
    ["RR", "AIRR", "ARR", "RRAG", "IRR", "AgARR"],
    ["REsp", "AREsp", "AgREsp", "EDv"],
    ["RE", "ARE"],
    ["HC", "RHC"],
    ["MS", "RMS"],
    ["RO", "ROE"],
]

# Constants of the smoothed hit rate.
SMOOTHING, PRIOR, LEAST_SEEN = 7, 0.97, 5

VERDICT_CLASSES = ["real", "inventada", "incompleta"]

FIELDS = T.StructType(
    [
        T.StructField("court", T.StringType()),
        T.StructField("case_class", T.StringType()),
        T.StructField("appeal_chain", T.ArrayType(T.StringType())),
        T.StructField("number", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("relator", T.StringType()),
        T.StructField("law_key", T.StringType()),
        T.StructField("article", T.StringType()),
        T.StructField("ocr_fixed", T.BooleanType()),
        T.StructField("source", T.StringType()),
    ]
)

REGISTRY = "id string, nature string, court string, number string, case_class string, appeal_chain array<string>, state string, year int, relator string, law_key string, article string"
SPAN = "struct<start: int, end: int>"
