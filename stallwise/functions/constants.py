"""Literals that results depend on, kept as the published analysis states them."""

# Order status values.
DELIVERED = "delivered"
CANCELED = "canceled"

# Payment types.
CREDIT_CARD = "credit_card"
BOLETO = "boleto"

# Member for products without a category.
UNKNOWN_CATEGORY = "unknown"

# Scores up to this one make a reviewer a detractor.
DETRACTOR_MAX_SCORE = 2

# Macro-regions of the country and their states; any other state is "Outro".
MACRO_REGIONS = {
    "Sudeste": ["SP", "RJ", "MG", "ES"],
    "Sul": ["PR", "SC", "RS"],
    "Nordeste": ["BA", "PE", "CE", "MA", "PB", "RN", "AL", "PI", "SE"],
    "Centro-Oeste": ["DF", "GO", "MT", "MS"],
    "Norte": ["PA", "AM", "RO", "TO", "AC", "AP", "RR"],
}
OTHER_REGION = "Outro"

# States of the North and Northeast, the focus of the local-supply lever.
FOCUS_STATES = MACRO_REGIONS["Nordeste"] + MACRO_REGIONS["Norte"]

# Calendar covered by the date dimension.
CALENDAR = ("2016-01-01", "2019-12-31")

# Complete months of the dataset, half-open.
COMPLETE_MONTHS = ("2017-01-01", "2018-09-01")

# Last complete half-year, half-open: the run-rate window of the lever sizing.
RUN_RATE = ("2018-01-01", "2018-07-01")

# Quality verdict limits, in percent.
PASS_LIMIT = 95.0
EXCELLENT_LIMIT = 99.0

# Lever assumptions.
CONVERSION_RATES = {"conservative": 0.08, "optimistic": 0.12}
TICKET_INCREMENT = 250.0
RECOVERY_RATE = 0.30
RECRUITS = {"conservative": 80, "optimistic": 120}

# Share of unclassified rows above which the classification must not be quoted.
FALLBACK_LIMIT = 0.05

# Review classification labels.
UNCLASSIFIED = "nao_classificado"
UNDETERMINED = "indeterminada"
SEVERITIES = ["alta", "media", "baixa"]
FALLBACK_REASON = "Falha na chamada ao modelo; registro não classificado"

# Words that set the complaint flags when a lot could not be classified.
DEADLINE_WORDS = ["prazo", "atraso"]
PRODUCT_WORDS = ["produto", "veio"]

# Category name parts that mark a failure the seller controls.
CONTROLLABLE_PARTS = ["incompleto", "divergente", "defeito"]

# Review sampling.
SAMPLE_SEED = 42
SAMPLE_SIZE = 400
LOT_SIZE = 50
