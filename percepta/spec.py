"""Column roles of a classification table.

A ``FeatureSpec`` names which column is the label, which is the row key,
which are continuous (imputed + standardized) and which are categorical
(encoded to integer codes, then one-hot). The feature vector is laid out as
the continuous columns in spec order followed by each categorical's one-hot
slots in spec order.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import types as T

from percepta import defaults as D


@dataclass(frozen=True)
class Encoding:
    """String value -> integer code; unknown non-null values get ``other``.

    ``null_as`` is the code of a NULL input (``None`` keeps NULL).
    """

    mapping: tuple[tuple[str, int], ...]
    other: int
    null_as: int | None = None


@dataclass(frozen=True)
class Categorical:
    """A categorical column and its one-hot layout.

    ``levels`` are the codes with an own slot; one trailing slot takes every
    other code. ``vector_null`` says what a NULL code becomes in the vector:
    an int code, ``"error"`` (fail the query) or ``"other"`` (last slot).
    """

    column: str
    levels: tuple[int, ...]
    encoding: Encoding | None = None
    vector_null: int | str = "error"

    @property
    def width(self) -> int:
        return len(self.levels) + 1


@dataclass(frozen=True)
class FeatureSpec:
    label: str | None
    key: str | None
    continuous: tuple[str, ...]
    categorical: tuple[Categorical, ...]
    passthrough: tuple[str, ...] = field(default_factory=tuple)

    @property
    def width(self) -> int:
        return len(self.continuous) + sum(c.width for c in self.categorical)

    def feature_names(self, prefix: str = "f") -> list[str]:
        return [f"{prefix}{i}" for i in range(self.width)]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> FeatureSpec:
        raw = json.loads(text)
        cats = []
        for c in raw["categorical"]:
            enc = c["encoding"]
            if enc is not None:
                enc = Encoding(
                    mapping=tuple((str(v), int(k)) for v, k in enc["mapping"]),
                    other=enc["other"],
                    null_as=enc["null_as"],
                )
            cats.append(
                Categorical(c["column"], tuple(c["levels"]), enc, c["vector_null"])
            )
        return FeatureSpec(
            label=raw["label"],
            key=raw["key"],
            continuous=tuple(raw["continuous"]),
            categorical=tuple(cats),
            passthrough=tuple(raw["passthrough"]),
        )


SEX = Encoding(D.SEX_CODES, D.SEX_OTHER)
PORT = Encoding(D.PORT_CODES, D.PORT_OTHER)
PORT_NULL_DEFAULT = Encoding(D.PORT_CODES, D.PORT_OTHER, null_as=D.PORT_NULL_CODE)

# The passenger table as the original jobs read it.
PASSENGERS = FeatureSpec(
    label="Survived",
    key="PassengerId",
    continuous=("Fare", "Age"),
    categorical=(
        Categorical("Sex", D.SEX_LEVELS, SEX, vector_null="error"),
        Categorical("Pclass", D.CLASS_LEVELS, None, vector_null="error"),
        Categorical("Embarked", D.PORT_LEVELS, PORT, vector_null=D.PORT_NULL_CODE),
    ),
    passthrough=("Parch", "SibSp"),
)

# The same roles over the test fixture built from ``orders`` (sources.fixture).
FIXTURE = FeatureSpec(
    label="label",
    key="entity_id",
    continuous=("amount", "tenure"),
    categorical=(
        Categorical("grp", D.SEX_LEVELS, SEX, vector_null="error"),
        Categorical("tier", D.CLASS_LEVELS, None, vector_null="error"),
        Categorical("site", D.PORT_LEVELS, PORT, vector_null=D.PORT_NULL_CODE),
    ),
    passthrough=("n_up", "n_side"),
)

# Explicit schema of a passenger CSV (header row), so a scan needs no inference pass.
PASSENGER_SCHEMA = T.StructType(
    [
        T.StructField("PassengerId", T.LongType()),
        T.StructField("Survived", T.IntegerType()),
        T.StructField("Pclass", T.IntegerType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Sex", T.StringType()),
        T.StructField("Age", T.DoubleType()),
        T.StructField("SibSp", T.IntegerType()),
        T.StructField("Parch", T.IntegerType()),
        T.StructField("Ticket", T.StringType()),
        T.StructField("Fare", T.DoubleType()),
        T.StructField("Cabin", T.StringType()),
        T.StructField("Embarked", T.StringType()),
    ]
)

# Scoring files have the same columns without the label.
SCORING_SCHEMA = T.StructType([f for f in PASSENGER_SCHEMA.fields if f.name != "Survived"])
