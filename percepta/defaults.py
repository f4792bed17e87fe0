"""Fixed values.

These must equal the original jobs' settings for the results to be the
same; they are stated here once, in the order the jobs use them, and every
function takes them as overridable parameters.
"""

from __future__ import annotations

# --- fixed values: category codes -------------------------------------------
# Sex: "male" -> 0, any other non-null string -> 1 (case-sensitive, no trim).
SEX_CODES = (("male", 0),)
SEX_OTHER = 1
# Port of embarkation: "S" -> 0, "C" -> 1, any other non-null string -> 2.
PORT_CODES = (("S", 0), ("C", 1))
PORT_OTHER = 2
# A missing port is read as code 0 ("S") when it enters the feature vector.
PORT_NULL_CODE = 0

# --- fixed values: one-hot slots ----------------------------------------------
# Sex code 0, then "other"; class 1, 2, then "other"; port code 0, 1, then "other".
SEX_LEVELS = (0,)
CLASS_LEVELS = (1, 2)
PORT_LEVELS = (0, 1)

# --- fixed values: constant fill of the export job ----------------------------
FILL_CONSTANTS = {"Age": 30, "Fare": 32.2}
EXPORT_DROP = ("PassengerId", "Name", "Ticket", "Cabin")
EXPORT_COLUMNS = (
    "Pclass", "Age", "SibSp", "Parch", "Fare", "sexIndex", "embarkedIndex", "Survived",
)
EXPORT_WEIGHTS = (0.7, 0.3)

# --- fixed values: validation split -------------------------------------------
SPLIT_WEIGHTS = (0.8, 0.2)
SPLIT_SEED = 12345

# --- fixed values: single MLP fit ---------------------------------------------
MLP_LAYERS = (10, 16, 32, 2)
MLP_BLOCK_SIZE = 128
MLP_SEED = 1234
MLP_TOL = 1e-8
MLP_MAX_ITER = 1000

# --- fixed values: cross-validated MLP ----------------------------------------
CV_LAYERS = (10, 16, 16, 2)
CV_BLOCK_SIZES = (32, 64, 128)
CV_MAX_ITERS = (10, 50)
CV_TOLS = (1e-2, 1e-4, 1e-6)
CV_FOLDS = 10
CV_METRIC = "f1"
