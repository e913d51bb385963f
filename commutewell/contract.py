"""The data contract: record layouts, table rules and the conform operator."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commutewell.functions.dates import as_date

# --- Fixed values: field names, types and order of the shared records -----------------------------

ACTIVITY = T.StructType(
    [
        T.StructField("id_salarie", T.IntegerType(), False),
        T.StructField("nom", T.StringType(), False),
        T.StructField("prenom", T.StringType(), False),
        T.StructField("date_naissance", T.StringType()),
        T.StructField("bu", T.StringType()),
        T.StructField("date_embauche", T.StringType()),
        T.StructField("salaire_brut", T.FloatType(), False),
        T.StructField("type_contrat", T.StringType()),
        T.StructField("jours_cp", T.IntegerType()),
        T.StructField("adresse_domicile", T.StringType()),
        T.StructField("moyen_de_deplacement", T.StringType(), False),
        T.StructField("date_activite", T.StringType()),
        T.StructField("type_sport", T.StringType()),
        T.StructField("distance_m", T.IntegerType()),
        T.StructField("duree_s", T.IntegerType()),
        T.StructField("calories", T.IntegerType()),
        T.StructField("commentaire", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("distance_km", T.DoubleType()),
        T.StructField("date_geocodage", T.StringType()),
        T.StructField("evolution_conges", T.IntegerType()),
    ]
)

REFERENCE = T.StructType(
    [
        T.StructField("id_salarie", T.IntegerType(), False),
        T.StructField("nom", T.StringType()),
        T.StructField("prenom", T.StringType()),
        T.StructField("date_naissance", T.DateType()),
        T.StructField("bu", T.StringType()),
        T.StructField("date_embauche", T.DateType()),
        T.StructField("salaire_brut", T.DoubleType()),
        T.StructField("type_contrat", T.StringType()),
        T.StructField("jours_cp", T.IntegerType()),
        T.StructField("adresse_domicile", T.StringType()),
        T.StructField("moyen_de_deplacement", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("distance_km", T.DoubleType()),
        T.StructField("date_geocodage", T.StringType()),
        T.StructField("evolution_conges", T.IntegerType()),
        T.StructField("date_activite", T.StringType()),
        T.StructField("type_sport", T.StringType()),
        T.StructField("distance_m", T.IntegerType()),
        T.StructField("duree_s", T.IntegerType()),
        T.StructField("calories", T.IntegerType()),
        T.StructField("commentaire", T.StringType()),
        T.StructField("source_donnees", T.StringType()),
    ]
)

ELIGIBILITY = T.StructType(
    [
        T.StructField("id_salarie", T.IntegerType(), False),
        T.StructField("annee_civile", T.IntegerType(), False),
        T.StructField("nombre_activites_total", T.LongType()),
        T.StructField("seuil_applique", T.IntegerType(), False),
        T.StructField("est_eligible", T.BooleanType(), False),
        T.StructField("date_calcul_dwh", T.TimestampType(), False),
        T.StructField("source_donnees", T.StringType(), False),
    ]
)

BONUS = T.StructType(
    [
        T.StructField("id_salarie", T.IntegerType(), False),
        T.StructField("annee_civile", T.IntegerType(), False),
        T.StructField("moyen_de_deplacement", T.StringType(), False),
        T.StructField("salaire_brut_base", T.DoubleType()),
        T.StructField("montant_prime", T.DoubleType()),
        T.StructField("statut_paiement", T.StringType()),
        T.StructField("date_calcul_dwh", T.TimestampType(), False),
        T.StructField("source_donnees", T.StringType(), False),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("id_salarie", T.IntegerType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# What one origin of activities adds to the facts of an employee, year and mode.
CONTRIBUTION = T.StructType(
    [
        T.StructField("origine", T.StringType(), False),
        T.StructField("id_salarie", T.IntegerType(), False),
        T.StructField("annee_civile", T.IntegerType(), False),
        T.StructField("moyen_de_deplacement", T.StringType(), False),
        T.StructField("nombre_activites", T.LongType()),
        T.StructField("nombre_jours", T.LongType()),
        T.StructField("salaire_brut", T.DoubleType()),
        T.StructField("dernier_moment", T.TimestampNTZType()),
    ]
)

# Headers of the HR export and the technical names they map to.
HR_HEADERS = {
    "ID salarié": "id_salarie",
    "Nom": "nom",
    "Prénom": "prenom",
    "Date de naissance": "date_naissance",
    "BU": "bu",
    "Date d'embauche": "date_embauche",
    "Salaire brut": "salaire_brut",
    "Type de contrat": "type_contrat",
    "Nombre de jours de CP": "jours_cp",
    "Adresse du domicile": "adresse_domicile",
    "Moyen de déplacement": "moyen_de_deplacement",
}

# Columns the warehouse adds to the business fields.
TECHNICAL_COLUMNS = ("source_donnees", "date_calcul_dwh")

# Values the three reference loads set whatever the input says; None means a typed NULL.
_NO_ACTIVITY = dict.fromkeys(
    ("latitude", "longitude", "date_activite", "type_sport", "distance_m", "duree_s", "calories", "commentaire")
)
HISTORY_FIXED = {
    **_NO_ACTIVITY,
    "distance_km": 5.0,
    "date_geocodage": "1970-01-01",
    "evolution_conges": 1,
    "source_donnees": "INITIAL_LOAD_BIS",
}
CSV_FIXED = {**HISTORY_FIXED, "evolution_conges": None, "source_donnees": "INITIAL_LOAD"}
LIVE_GEO_FIXED = {
    "latitude": 43.6,
    "longitude": 3.9,
    "distance_km": 10.5,
    "evolution_conges": 0,
    "source_donnees": "LIVE",
}

# --------------------------------------------------------------------------------------------------


class ContractViolation(ValueError):
    """Data or schema that a contract refuses."""


@dataclass(frozen=True)
class TableContract:
    """Layout and rules of one gold table.

    ``partition_by`` names the column whose values are directories; a keyed merge rewrites only the
    directories its source touches, so the column must be part of ``keys``. A table without such a column may be
    cut to ``buckets`` by a hash of its keys instead, each a directory of its own.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)
    partition_by: str | None = None
    buckets: int = 0

    def bucket(self) -> Column:
        """Bucket of a row by its keys, whatever integer or text type they come in."""
        keys = [F.col(k).cast(self.schema[k].dataType) for k in self.keys]
        return F.pmod(F.hash(*keys), F.lit(self.buckets))

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def not_null(self) -> list[str]:
        """Key columns and the columns the layout marks as required."""
        return [f.name for f in self.schema.fields if not f.nullable or f.name in self.keys]

    def enforce(self, df: DataFrame) -> DataFrame:
        """``df`` in the table's columns, order and types; absent columns get their default."""
        missing = {c: v for c, v in self.defaults.items() if c not in df.columns}
        return conform(df, self.schema, missing)

    def null_violations(self, df: DataFrame) -> DataFrame:
        """Rows that hold NULL in a required column. Parquet statistics prune clean files."""
        broken = F.lit(False)
        for name in self.not_null:
            broken = broken | F.col(name).isNull()
        return df.where(broken)

    def key_violations(self, df: DataFrame) -> DataFrame:
        """Keys held by more than one row, with their row count ``n``."""
        return key_violations(df, self.keys)


BONUS_TABLE = TableContract(
    "fct_primes_transport",
    BONUS,
    keys=("id_salarie", "annee_civile", "moyen_de_deplacement"),
    defaults={"statut_paiement": "A PAYER"},
    partition_by="annee_civile",
)
ELIGIBILITY_TABLE = TableContract(
    "fct_bien_etre_eligibilite", ELIGIBILITY, keys=("id_salarie", "annee_civile"), partition_by="annee_civile"
)
REFERENCE_TABLE = TableContract("ref_salaries", REFERENCE, keys=("id_salarie",), buckets=8)
CONTRIBUTION_TABLE = TableContract(
    "contributions",
    CONTRIBUTION,
    keys=("origine", "id_salarie", "annee_civile", "moyen_de_deplacement"),
    partition_by="annee_civile",
)
QUARANTINE_TABLE = TableContract("soda_failed_rows", QUARANTINE)


def key_violations(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keys held by more than one row. A NULL in any key column conflicts with nothing, as in SQL.

    The count is combined on the map side, so a key that holds most rows costs one row per task.
    """
    keys = list(keys)
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def conform(df: DataFrame, schema: T.StructType, fixed: Mapping[str, object] | None = None) -> DataFrame:
    """``df`` in exactly the columns, order and types of ``schema``, in one projection.

    A column in ``fixed`` takes that value whatever ``df`` holds; a column of ``df`` is cast;
    anything else is a typed NULL. A value that does not fit becomes NULL; ``cast_failures`` finds those.
    """
    fixed = fixed or {}
    present = {f.name: f.dataType for f in df.schema.fields}

    def column(f: T.StructField) -> Column:
        if f.name in fixed:
            value = fixed[f.name]
            column = value if isinstance(value, Column) else F.lit(value)
            return column.cast(f.dataType).alias(f.name)
        if f.name not in present:
            return F.lit(None).cast(f.dataType).alias(f.name)
        value = F.col(f.name)
        if present[f.name] == f.dataType:
            return value
        return _converted(value, present[f.name], f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


def _converted(value: Column, present: T.DataType, wanted: T.DataType) -> Column:
    if isinstance(wanted, T.DateType) and isinstance(present, T.StringType):
        return as_date(value)
    return value.try_cast(wanted)


def cast_failures(
    df: DataFrame, schema: T.StructType, key: str, fixed: Mapping[str, object] | None = None
) -> DataFrame:
    """Rows ``(key, column, text)`` for the values that ``conform`` turns into NULL because they do not fit.

    Blank text stands for a missing value and is no failure.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    failures = []
    for f in schema.fields:
        if f.name in (fixed or {}) or f.name not in present or present[f.name] == f.dataType:
            continue
        text = F.col(f.name).cast("string")
        lost = (F.trim(text) != "") & _converted(F.col(f.name), present[f.name], f.dataType).isNull()
        failures.append(F.when(lost, F.struct(F.lit(f.name).alias("column"), text.alias("text"))))
    none = F.lit(None).cast("struct<column:string,text:string>")
    found = F.explode(F.array_compact(F.array(*failures, none))).alias("_failure")
    return df.select(F.col(key).cast("string").alias("key"), found).select("key", "_failure.*")


def require_readable(df: DataFrame, schema: T.StructType, key: str, fixed: Mapping[str, object] | None = None) -> None:
    """Raise ``ContractViolation``, with a few examples, when a value of ``df`` does not fit ``schema``."""
    examples = cast_failures(df, schema, key, fixed).limit(5).collect()
    if examples:
        raise ContractViolation(f"values that do not fit their column: {[tuple(r) for r in examples]}")


def contract_diff(
    contract: T.StructType | Iterable[str],
    columns: Iterable[str],
    technical: Iterable[str] = TECHNICAL_COLUMNS,
    strict: bool = True,
) -> list[str]:
    """Contract fields the table lacks, technical columns aside; raises unless ``strict`` is off."""
    wanted = contract.names if isinstance(contract, T.StructType) else list(contract)
    have = set(columns) - set(technical)
    missing = [name for name in wanted if name not in have]
    if missing and strict:
        raise ContractViolation(f"columns missing from the table: {', '.join(missing)}")
    return missing


def missing_fields(spark: SparkSession, contract: T.StructType | Iterable[str], observed: DataFrame) -> DataFrame:
    """Contract fields that do not occur in ``observed``, a one-column frame of field names.

    For payloads whose fields are only known from the data, such as the keys of JSON messages.
    """
    names = contract.names if isinstance(contract, T.StructType) else list(contract)
    wanted = spark.range(1).select(F.explode(F.array(*map(F.lit, names))).alias("missing_column"))
    seen = observed.toDF("_field").distinct()
    return wanted.join(seen, F.col("missing_column") == F.col("_field"), "left_anti")
