"""The survey's household feature catalogue as data.

Names, code sets and thresholds below are fixed values: they must equal the survey
definitions for the features to mean what they mean.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hhlens.functions.recode import dummy, flag, guard, inset, null_guarded, square
from hhlens.operators.rollup import Feature

KEY = "id"


def head_pred():
    """Designated member: the head of household (relationship code 1)."""
    return F.col("P6050") == 1


def _c(n):
    return F.col(n)


def features() -> list[Feature]:
    """The 42 household features, in the order the scripts compute them (built on demand:
    Column objects need an active session)."""
    return _features()


# The 42 household features.
def _features() -> list[Feature]:
  return [
    Feature("num_personas", "all", "count"),
    Feature("trabajando", "member", "sum", inset("P6240", [1, 2])),
    Feature("JH_Mujer", "member", "avg", flag(_c("P6020") == 2)),
    Feature("JH_Edad", "member", "avg", _c("P6040")),
    Feature("JH_Edad2", "member", "avg", square("P6040")),
    Feature("JH_RSS_S", "member", "member", guard(dummy("P6100", 3), 0), cast="double"),
    Feature("JH_NEduc", "member", "avg", _c("P6210")),
    Feature("JH_CotizaPension", "member", "member", guard(dummy("P6920", 1), 0), cast="double"),
    Feature("JH_Pensionado", "member", "member", guard(dummy("P6920", 3), 0), cast="double"),
    Feature("JH_Oc", "member", "member", guard("Oc", 0), cast="double"),
    Feature("JH_Des", "member", "member", guard("Des", 0), cast="double"),
    Feature("JH_Ina", "member", "member", guard("Ina", 0), cast="double"),
    Feature("JH_NoSeguro", "member", "member", flag(_c("P6090") == 2), cast="double"),
    Feature("JH_RSS_Subsidiado", "member", "member", flag(_c("P6100") == 3), cast="double"),
    Feature("JH_BasicaSecundaria", "member", "member", inset("P6210", [1, 2, 3, 4, 9]), cast="double"),
    Feature("JH_Media", "member", "member", flag(_c("P6210") == 5), cast="double"),
    Feature("JH_Trabaja", "member", "member", flag(_c("P6240") == 1), cast="double"),
    Feature("JH_HorasExt", "member", "member", null_guarded("P6800", flag(_c("P6800") >= 40)),
            cast="double"),
    Feature("JH_Independiente", "member", "member", flag(_c("P6870") == 1), cast="double"),
    Feature("JH_Microempresa", "member", "member", inset("P6870", [2, 3, 4]), cast="double"),
    Feature("JH_Pequena", "member", "member", inset("P6870", [5, 6, 7]), cast="double"),
    Feature("JH_Mediana_Grande", "member", "member", inset("P6870", [8, 9]), cast="double"),
    Feature("JH_NoTrabaja", "member", "member", _c("P6870").isNull().cast("int"), cast="double"),
    Feature("JH_Vulnerable", "member", "member", inset("P6430", [4, 6, 7, 8]), cast="double"),
    Feature("JH_Alim", "member", "member", inset("P6590", [1]), cast="double"),
    Feature("JH_Vivienda", "member", "member", inset("P6600", [1]), cast="double"),
    Feature("JH_Horas_Trabajo", "member", "member", guard("P6800", 0), cast="double"),
    Feature("JH_Personas_Trabajo", "member", "member", null_guarded("P6870", _c("P6800")),
            cast="double"),
    Feature("JH_Segundo_Trabajo", "member", "member", null_guarded("P7040", flag(_c("P7040") == 1)),
            cast="double"),
    Feature("Educ_prom", "all", "avg", _c("P6210")),
    Feature("Adultos", "all", "count_if", _c("P6040") >= 18),
    Feature("Trabajadores", "all", "count_if", _c("P6240").isin(1, 2)),
    Feature("Hijos", "all", "count_if", _c("P6040") < 18),
    Feature("Subsidios", "all", "sum", _c("P6585s1"), cast="bigint"),
    Feature("CotizaPension", "all", "count_if", _c("P6920") == 1),
    Feature("Pensionado", "all", "count_if", _c("P6920") == 3),
    Feature("Ingresos_AlquilerPensiones", "all", "any_nonzero", _c("P7495")),
    Feature("OtrosIngresos", "all", "any_nonzero", _c("P7505")),
    Feature("AyudasEco", "all", "any_nonzero", _c("P7510s3")),
    Feature("TGP", "all", "ratio", num_terms=("Ina",), den_terms=("Pet",)),
    Feature("P_o", "all", "ratio", num_terms=("Oc",), den_terms=("Pet",)),
    Feature("tasa_desempleo", "all", "ratio", num_terms=("Des",), den_terms=("Oc", "Des")),
  ]


def feature(name: str) -> Feature:
    return {f.name: f for f in features()}[name]

# Features merged into the household table, in the merge order of the
# training side (JH_NoTrabaja is computed but never merged).
JOINED = [
    "num_personas", "trabajando", "JH_Mujer", "JH_Edad", "JH_Edad2", "JH_RSS_S",
    "JH_RSS_Subsidiado", "JH_NEduc", "JH_CotizaPension", "JH_Pensionado", "JH_Oc", "JH_Des",
    "JH_Ina", "JH_NoSeguro", "JH_BasicaSecundaria", "JH_Media", "Hijos", "Educ_prom",
    "JH_Independiente", "JH_Microempresa", "JH_Pequena", "JH_Mediana_Grande", "Adultos",
    "Trabajadores", "Subsidios", "CotizaPension", "Pensionado", "JH_Trabaja", "JH_HorasExt",
    "Ingresos_AlquilerPensiones", "OtrosIngresos", "AyudasEco", "TGP", "P_o",
    "tasa_desempleo", "JH_Vulnerable", "JH_Alim", "JH_Horas_Trabajo", "JH_Personas_Trabajo",
    "JH_Vivienda", "JH_Segundo_Trabajo",
]

# Household columns dropped before and filled with 0 after the merge.
DROPPED = ["P5100", "P5140"]
FILL_ZERO = ["TGP", "P_o", "JH_NoSeguro", "JH_RSS_Subsidiado", "JH_Trabaja", "JH_HorasExt",
             "JH_Independiente", "P5130", "tasa_desempleo"]

# Person code columns turned into dummies.
FACTOR_COLUMNS = ["P6100", "P6920"]

# Predictor sets of the models.
LINEAR_PREDICTORS = [
    "JH_RSS_S", "Hijos", "Subsidios", "Nper", "Educ_prom", "P5130", "TGP", "Trabajadores",
    "JH_CotizaPension", "Lp", "JH_NEduc", "tasa_desempleo", "P5000", "JH_Edad", "P5090",
    "JH_NoSeguro", "JH_Personas_Trabajo", "AyudasEco",
]
FOREST_TRIAL_PREDICTORS = [
    "JH_Mujer", "JH_Edad", "JH_RSS_S", "JH_NEduc", "JH_CotizaPension", "JH_Oc", "JH_NoSeguro",
    "Hijos", "Educ_prom", "JH_Independiente", "JH_Microempresa", "JH_Pequena",
    "JH_Mediana_Grande", "Adultos", "Trabajadores", "Subsidios", "Pensionado", "JH_Trabaja",
    "JH_HorasExt", "OtrosIngresos", "AyudasEco", "TGP", "JH_Vulnerable", "JH_Alim",
    "JH_Horas_Trabajo", "JH_Personas_Trabajo", "JH_Vivienda", "JH_Segundo_Trabajo", "P5000",
    "P5010", "P5090", "tasa_desempleo", "P5130", "Nper", "Lp",
]
FOREST_FINAL_PREDICTORS = [
    "JH_RSS_S", "Hijos", "Subsidios", "Nper", "Educ_prom", "P5130", "TGP", "Trabajadores",
    "JH_CotizaPension", "Lp", "JH_NEduc", "tasa_desempleo", "P5000", "JH_Edad", "P5090",
    "P5010", "Adultos", "JH_NoSeguro", "JH_Personas_Trabajo", "AyudasEco",
]
LABEL = "Pobre"

# Label decoding and the department lookup of the description script.
POBRE_LABELS = {0: "No Pobres", 1: "Pobres"}
DEPARTAMENTOS = [
    (5, "ANTIOQUIA"), (8, "ATLANTICO"), (11, "BOGOTA"), (13, "BOLIVAR"), (15, "BOYACA"),
    (17, "CALDAS"), (18, "CAQUETA"), (19, "CAUCA"), (20, "CESAR"), (23, "CORDOBA"),
    (25, "CUNDINAMARCA"), (27, "CHOCO"), (41, "HUILA"), (44, "LA GUAJIRA"), (47, "MAGDALENA"),
    (50, "META"), (52, "NARIÑO"), (54, "NORTE SANTANDER"), (63, "QUINDIO"), (66, "RISARALDA"),
    (68, "SANTANDER"), (70, "SUCRE"), (73, "TOLIMA"), (76, "VALLE"), (81, "ARAUCA"),
    (85, "CASANARE"), (86, "PUTUMAYO"), (88, "SAN ANDRES"), (91, "AMAZONAS"), (94, "GUAINIA"),
    (95, "GUAVIARE"), (97, "VAUPES"), (99, "VICHADA"),
]

# Tuning grids (candidates x folds) of the model scripts.
RIDGE_LAMBDAS = [10 ** (-4 + 8 * i / 99) for i in range(100)]          # 10^seq(-4, 4, length=100)
LASSO_LAMBDAS = [round(0.01 * i, 2) for i in range(1001)]              # seq(0, 10, by=0.01)
ENET_ALPHAS = [round(0.1 * i, 1) for i in range(11)]                   # seq(0, 1, by=0.1)
ENET_LAMBDAS = [round(0.1 * i, 1) for i in range(101)]                 # seq(0, 10, by=0.1)
LINEAR_FOLDS = 10
FOREST_FOLDS = 5
FOREST_TRIAL_GRID = {"mtry": [4, 8], "min_node_size": [1, 10]}
FOREST_FINAL_GRID = {"mtry": [2, 4, 6, 8, 10, 12, 16, 20], "min_node_size": [1, 5, 10, 20]}
FOREST_TRIAL_TREES = 5
FOREST_FINAL_TREES = 300
SEED = 123
THRESHOLD = 0.5
TRAIN_SHARE = 0.7
EXTERNAL_SCORE = 0.6703      # competition score reported next to the hold-out metrics
