"""Fixed values of the measurement model.

These names and limits must equal the reference's for equal results; they are
stated here plainly, in their natural order.
"""

LABEL = "Potability"
ROW_ID = "row_id"

# The nine raw measurement columns, in source order.
FEATURES = [
    "ph",
    "Hardness",
    "Solids",
    "Chloramines",
    "Sulfate",
    "Conductivity",
    "Organic_carbon",
    "Trihalomethanes",
    "Turbidity",
]

# Ratio features as (name, numerator, denominator); divisor gets + 1e-5.
RATIO_FEATURES = [
    ("Hardness_to_pH", "Hardness", "ph"),
    ("Solids_to_Conductivity", "Solids", "Conductivity"),
    ("Chloramines_to_pH", "Chloramines", "ph"),
    ("Organic_to_Trihalomethanes", "Organic_carbon", "Trihalomethanes"),
    ("Sulfate_to_Conductivity", "Sulfate", "Conductivity"),
]
RATIO_EPSILON = 1e-5

# Two-column means as (name, a, b).
INDEX_FEATURES = [
    ("Chemical_Index", "Chloramines", "Sulfate"),
    ("Physical_Index", "Hardness", "Turbidity"),
    ("Organic_Index", "Organic_carbon", "Trihalomethanes"),
]

# Squared columns and the one sum column.
SQUARED_FEATURES = [("ph_squared", "ph"), ("Turbidity_squared", "Turbidity")]
SUM_FEATURES = [("Total_Dissolved", "Solids", "Sulfate")]

# The key features whose pairwise products form interactions.
INTERACTION_KEYS = ["ph", "Hardness", "Solids", "Chloramines", "Turbidity"]

DERIVED_FEATURES = (
    [r[0] for r in RATIO_FEATURES]
    + [r[0] for r in INDEX_FEATURES]
    + [s[0] for s in SQUARED_FEATURES]
    + [s[0] for s in SUM_FEATURES]
)

# Drinking-water limits as (feature, min, max, importance).
STANDARDS = [
    ("ph", 6.5, 8.5, "high"),
    ("Hardness", None, 500.0, "medium"),
    ("Sulfate", None, 500.0, "medium"),
    ("Chloramines", None, 3.0, "high"),
    ("Turbidity", None, 5.0, "high"),
    ("Trihalomethanes", None, 300.0, "high"),
]

# Alignment classes by importance rank (rank <= 10 high, <= 15 medium, else low).
ALIGNMENT_HIGH_RANK = 10
ALIGNMENT_MEDIUM_RANK = 15

# Display names of the label classes and quartile labels.
LABEL_NAMES = {1: "Potable", 0: "Not Potable"}
QUARTILE_LABELS = ["Q1_Low", "Q2", "Q3", "Q4_High"]

# Noise levels of the robustness experiment.
NOISE_LEVELS = [0.0, 0.05, 0.10, 0.15, 0.20]

# Substrings that tag a feature in the importance report.
FEATURE_TAGS = ["ph", "Chloramines", "Turbidity"]

SEED = 42
