"""The event declarations file: text columns named by the header, typing as a separate step."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields of the open-data declarations file, in file order.
DECLARED_TYPES = {
    "declaration_creation": "string",
    "declaration_modification": "string",
    "declarant_ID_sibil": "string",
    "declarant_nom": "string",
    "declarant_nom_usuel": "string",
    "declarant_statut": "string",
    "demandeur_ID_sibil": "int",
    "demandeur_role": "string",
    "declarant_siret": "string",
    "declarant_code_postal": "string",
    "declarant_ville": "string",
    "declarant_departement": "string",
    "declarant_region": "string",
    "declarant_numero_dossier": "string",
    "declarant_numero_licence": "string",
    "declaration_ID_sibil": "int",
    "declaration_ID_externe": "string",
    "declaration_date_representation": "string",
    "declaration_statut": "string",
    "declaration_cause_erreur": "string",
    "declaration_gestionnaires_multiples": "boolean",
    "festival_ID_parent_sibil": "int",
    "festival_nom_parent": "string",
    "festival_ID_sibil": "int",
    "festival_nom": "string",
    "festival_ville": "string",
    "festival_code_postal": "int",
    "festival_date_creation": "string",
    "festival_statut": "string",
    "festival_contributeur_ID_sibil": "int",
    "festival_validateur_ID_sibil": "int",
    "festival_cause_erreur_adresse": "string",
    "lieu_ID_parent_sibil": "int",
    "lieu_nom_parent": "string",
    "lieu_ID_sibil": "int",
    "lieu_nom": "string",
    "lieu_nom_usuel": "string",
    "lieu_adresse": "string",
    "lieu_code_postal": "string",
    "lieu_ville": "string",
    "lieu_siret": "bigint",
    "lieu_departement_code": "int",
    "lieu_departement_nom": "string",
    "lieu_date_creation": "string",
    "lieu_statut": "string",
    "lieu_contributeur_ID_sibil": "int",
    "lieu_validateur_ID_sibil": "int",
    "lieu_cause_erreur_adresse": "string",
}


def read_declarations(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon-separated declarations with a header; every column is text.

    White space inside fields is kept and an empty field is null. The header
    names the columns, so a file may order them as it likes.
    """
    return (
        spark.read.option("header", True)
        .option("sep", ";")
        .option("quote", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )


def apply_declared_types(declarations: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Cast the known columns by name; a value that does not fit becomes null."""
    types = DECLARED_TYPES if types is None else types
    return declarations.select(
        *[
            F.col(name).try_cast(types[name]).alias(name) if name in types else F.col(name)
            for name in declarations.columns
        ]
    )
