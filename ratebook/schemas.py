"""Explicit schemas: nothing in this package infers a schema from data."""

from pyspark.sql import types as T

RATE_SCHEDULE = T.StructType(
    [
        T.StructField("service_category", T.StringType()),
        T.StructField("cpt_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("rate_type", T.StringType()),
        T.StructField("rate_amount", T.DecimalType(12, 2)),
        T.StructField("effective_date", T.StringType()),
        T.StructField("rate_unit", T.StringType()),
        T.StructField("modifier", T.StringType()),
    ]
)

AMENDMENT = T.StructType(
    [
        T.StructField("amendment_id", T.StringType()),
        T.StructField("amendment_date", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("rate_changes", T.StringType()),
        T.StructField("effective_date", T.StringType()),
        T.StructField("amendment_type", T.StringType()),
    ]
)

EXTRACTION_METADATA = T.StructType(
    [
        T.StructField("extracted_at", T.StringType()),
        T.StructField("confidence_score", T.DecimalType(5, 4)),
        T.StructField("source_file", T.StringType()),
        T.StructField("extractor_version", T.StringType()),
    ]
)

# One contract document. `loaded_at` is added when the document is loaded.
CONTRACT_DOCUMENT = T.StructType(
    [
        T.StructField("contract_id", T.StringType()),
        T.StructField("payer_name", T.StringType()),
        T.StructField("payer_id", T.StringType()),
        T.StructField("provider_npi", T.StringType()),
        T.StructField("provider_name", T.StringType()),
        T.StructField("effective_date", T.StringType()),
        T.StructField("termination_date", T.StringType()),
        T.StructField("rate_schedules", T.ArrayType(RATE_SCHEDULE)),
        T.StructField("amendments", T.ArrayType(AMENDMENT)),
        T.StructField("extraction_metadata", EXTRACTION_METADATA),
    ]
)

RAW_CONTRACTS = T.StructType(
    CONTRACT_DOCUMENT.fields + [T.StructField("loaded_at", T.TimestampType())]
)

TABLE = T.StructType(
    [
        T.StructField("headers", T.ArrayType(T.StringType())),
        T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)

# Input of the extraction plan: the text and the tables of one document.
DOCUMENT_TEXT = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("tables", T.ArrayType(TABLE)),
    ]
)

# What the binaryFile source delivers; a stream needs it spelled out.
BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)

OBJECT_EVENT = T.StructType(
    [
        T.StructField(
            "Records",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "s3",
                            T.StructType(
                                [
                                    T.StructField(
                                        "bucket",
                                        T.StructType([T.StructField("name", T.StringType())]),
                                    ),
                                    T.StructField(
                                        "object",
                                        T.StructType([T.StructField("key", T.StringType())]),
                                    ),
                                ]
                            ),
                        )
                    ]
                )
            ),
        ),
        T.StructField("Message", T.StringType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)

SEEDS = {
    "contracts": T.StructType(
        [
            T.StructField(name, T.StringType())
            for name in (
                "contract_id",
                "payer_name",
                "payer_id",
                "provider_npi",
                "provider_name",
                "effective_date",
                "termination_date",
                "rate_schedules",
                "amendments",
            )
        ]
    ),
    "rate_schedules": T.StructType(
        [
            T.StructField("contract_id", T.StringType()),
            T.StructField("service_category", T.StringType()),
            T.StructField("cpt_code", T.StringType()),
            T.StructField("rate_type", T.StringType()),
            T.StructField("rate_amount", T.DecimalType(12, 2)),
            T.StructField("effective_date", T.StringType()),
            T.StructField("rate_unit", T.StringType()),
            T.StructField("modifier", T.StringType()),
        ]
    ),
    "amendments": T.StructType(
        [
            T.StructField(name, T.StringType())
            for name in (
                "amendment_id",
                "contract_id",
                "amendment_date",
                "description",
                "rate_changes",
            )
        ]
    ),
    "ref_payers": T.StructType(
        [
            T.StructField(name, T.StringType())
            for name in ("payer_id", "payer_name", "payer_type", "payer_state", "payer_website")
        ]
    ),
    "ref_service_categories": T.StructType(
        [
            T.StructField(name, T.StringType())
            for name in ("category_code", "category_name", "description")
        ]
    ),
}
