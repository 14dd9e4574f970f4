"""Landing operators: mirrors of application tables and of nested API documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sedimart.functions.fixed import CARD_FIELDS, DETAIL_FIELDS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def paging_column(columns: list[str]) -> str:
    """Order column of a mirror: ``id``, else ``create_ts``, else the first column."""
    for name in ("id", "create_ts"):
        if name in columns:
            return name
    if not columns:
        raise ValueError("the source has no column to order by")
    return columns[0]


def mirror_table(src: DataFrame, target_cols: list[str], order_col: str | None = None) -> DataFrame:
    """Columns that source and target share; nested columns become JSON text.

    ``order_col`` sorts within the written files, so that later reads skip row groups by it.
    The copy itself needs no order and no shuffle: every input split is copied on its own.
    """
    shared = [f for f in src.schema.fields if f.name in set(target_cols)]
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    out = src.select(
        *[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in shared]
    )
    if order_col is None:
        return out
    return out.sortWithinPartitions(order_col)


def flatten_json(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested objects to ``a_b_c`` columns; arrays stay as they are."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        found = []
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                found += leaves(field.dataType, here)
            else:
                found.append(F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here)))
        return found

    return df.select(*leaves(df.schema, ()))


def array_field_join(df: DataFrame, col: str, field: str, sep: str = ", ") -> DataFrame:
    """A list of objects becomes the separated text of one of their fields."""
    return df.withColumn(col, F.array_join(F.transform(F.col(col), lambda x: x[field]), sep))


def stack_children(
    frames: list[DataFrame], parent_col: str, parent_ids: list | None = None, renames: dict[str, str] | None = None
) -> DataFrame:
    """Per-parent frames as one, each row stamped with its parent; missing columns become NULL.

    With ``parent_ids`` the i-th frame is stamped with the i-th id; without, the frames carry
    ``parent_col`` already.
    """
    stamped = frames
    if parent_ids is not None:
        stamped = [f.withColumn(parent_col, F.lit(p)) for f, p in zip(frames, parent_ids, strict=True)]
    out = stamped[0]
    for frame in stamped[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out.withColumnsRenamed(renames or {})


def members_ingest(members: DataFrame, details: DataFrame) -> DataFrame:
    """Member list joined with the per-member detail documents, the card object flattened.

    A detail field wins over a list field of the same name; fields that the documents lack are
    NULL, and so are the card columns of a member without card.
    """
    present = {"faculty_title_eng", *DETAIL_FIELDS} & set(details.columns)
    detail = details.select(
        F.col("id"),
        *[
            F.col(c).alias("faculty_translated" if c == "faculty_title_eng" else c)
            for c in ["faculty_title_eng", *DETAIL_FIELDS]
            if c in present
        ],
    )
    taken = set(detail.columns) - {"id"}
    kept = members.select(*[c for c in members.columns if c not in taken])
    joined = kept.join(detail, "id", "left")
    for name in ["faculty_translated", *DETAIL_FIELDS]:
        if name not in joined.columns:
            joined = joined.withColumn(name, F.lit(None).cast("string"))
    if "card" not in members.columns:
        return joined.withColumns({f"card_{f}": F.lit(None).cast("string") for f in CARD_FIELDS})
    card_type = members.schema["card"].dataType
    has = set(card_type.names) if isinstance(card_type, T.StructType) else set()
    card = {
        f"card_{f}": F.col("card")[f] if f in has else F.lit(None).cast("string") for f in CARD_FIELDS
    }
    return joined.withColumns(card).drop("card")


LESSON_SCHEMA = (
    "study_groups array<struct<id bigint, name string>>, discipline struct<id bigint, name string>, "
    "classroom struct<id bigint, name string>, lesson_type struct<name string>, date string, "
    "time_from string, time_to string, "
    "teacher_users array<struct<id bigint, sur_name string, first_name string, second_name string>>"
)


def lessons_ingest(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lesson documents (``LESSON_SCHEMA``) as flat rows, and the documents that lack a needed part.

    The discipline column keeps the source system's spelling.
    """
    moment = lambda part: F.try_to_timestamp(
        F.concat_ws(" ", F.col("date"), F.col(part)), F.lit("yyyy-MM-dd HH:mm")
    ).cast("timestamp_ntz")
    first_group = F.get("study_groups", F.lit(0))
    needed = {
        "no study group": first_group.isNull(),
        "no discipline": F.col("discipline").isNull(),
        "no classroom": F.col("classroom").isNull(),
        "no lesson type": F.col("lesson_type").isNull(),
        "no start": moment("time_from").isNull(),
        "no end": moment("time_to").isNull(),
        "no teachers": F.col("teacher_users").isNull(),
    }
    reason = F.lit(None).cast("string")
    for text, lacking in reversed(needed.items()):
        reason = F.when(lacking, text).otherwise(reason)
    checked = df.withColumn("reject_reason", reason)
    rows = checked.filter("reject_reason is null").select(
        first_group["name"].alias("group_name"),
        F.col("discipline.name").alias("dicscipline_name"),
        F.col("discipline.id").alias("discipline_id"),
        F.col("classroom.name").alias("classroom_name"),
        F.col("classroom.id").alias("classroom_id"),
        F.col("lesson_type.name").alias("lesson_type_text"),
        moment("time_from").alias("lesson_from_dttm_ts"),
        moment("time_to").alias("lesson_to_dttm_ts"),
        F.to_json("teacher_users").alias("teacher_users"),
        F.to_json("study_groups").alias("study_groups"),
    )
    return rows, checked.filter("reject_reason is not null")


def load_backup(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One-time load of a dumped table, with a fixed schema and no guessing."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("quote", "'").option("escape", "'").csv(path)
