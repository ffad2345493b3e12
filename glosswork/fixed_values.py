"""Thresholds, limits and lookup tables that decide results."""

# Quality gate and retrieval limits (fixed values).
ROUGE_GATE = 0.15
TOP_K = 8
CANDIDATES = 2 * TOP_K
SEARCH_TOP_K = 5
VECTOR_TOP_K = 3
ENOUGH_HITS = 4
KEYWORD_RELEVANCE = 0.1
SAFETY_RELEVANCE = 0.05
EMBED_DIM = 384
SUMMARY_MAX_WORDS = 100
SMALLEST_TOPIC = 10
TERM_MIN_DOCS = 2
LABEL_WORDS = 3
SEED = 42

# Query words shorter than this are ignored: search terms, fallback keywords.
TERM_MIN_LENGTH = 3
KEYWORD_MIN_LENGTH = 4

# BM25 (Robertson and Zaragoza 2009).
BM25_K1 = 1.2
BM25_B = 0.75

# Keyword -> topic label, first match in this order wins (fixed values).
TOPIC_KEYWORDS = [
    ("cancer", "cancer_radiation_patients"),
    ("radiation", "cancer_radiation_patients"),
    ("tumor", "cancer_radiation_patients"),
    ("oncology", "cancer_radiation_patients"),
    ("heart", "patients_pressure_angina"),
    ("cardiac", "patients_pressure_angina"),
    ("angina", "patients_pressure_angina"),
    ("cardiovascular", "patients_pressure_angina"),
    ("pressure", "patients_pressure_angina"),
    ("smoking", "smoking_assigned_children"),
    ("cigarette", "smoking_assigned_children"),
    ("children", "smoking_assigned_children"),
    ("infant", "infants_milk_vitamin"),
    ("milk", "infants_milk_vitamin"),
    ("vitamin", "infants_milk_vitamin"),
    ("glucose", "glucose_cholesterol_blood glucose"),
    ("cholesterol", "glucose_cholesterol_blood glucose"),
    ("diabetes", "glucose_cholesterol_blood glucose"),
    ("gastric", "gastric_ph_subjects"),
    ("stomach", "gastric_ph_subjects"),
    ("arthritis", "arthritis_patients_months"),
    ("joint", "arthritis_patients_months"),
    ("lung", "pulmonary_training_chest"),
    ("pulmonary", "pulmonary_training_chest"),
    ("urine", "urine_excretion_salt"),
    ("kidney", "urine_excretion_salt"),
    ("plasma", "healthy_mg_plasma"),
    ("magnesium", "healthy_mg_plasma"),
    ("randomized", "patients_randomized_prospective"),
    ("postoperative", "topical_postoperative_objective"),
]

# The prompt around a context block and a question (fixed text).
PROMPT_HEAD = "Here are PubMed research summaries retrieved for this query:\n\n---\n"
PROMPT_MIDDLE = "\n---\n\nUsing ONLY the summaries above, answer this question:\n"
PROMPT_TAIL = "\n\nReference specific findings from the summaries."
BLANK_QUERY_REPLY = "Please enter a query."

# English stop words (fixed values; the public Snowball list).
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves "
    "he him his himself she her hers herself it its itself they them their "
    "theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the "
    "and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in "
    "out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don should now"
).split()
