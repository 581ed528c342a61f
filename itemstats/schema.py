"""Column names and schemas shared by every operator.

The core table is long: one row per (batch, student, attempt, item).

* ``responses(paper_code, create_time, stu_code, attempt, section, item_id, score)``
  at most one row per (paper_code, create_time, stu_code, attempt, item_id);
  a missing row is a missing cell (treated like a null score).
* ``blueprint(paper_code, section, kind, qty, full_mark)``: one row per section,
  ``kind`` is ``objective`` or ``subjective``, ``full_mark`` is the mark of each
  item in the section; items are numbered across the whole paper.
* ``items(paper_code, section, kind, item_id, full_mark)``: the blueprint expanded.
* ``item_knowledge(paper_code, kl_id, item_id)``: many-to-many.
"""

from pyspark.sql import types as T

# A batch is one paper's answers submitted at one time; every result is keyed by it.
BATCH_KEYS = ["paper_code", "create_time"]
# One sample: a student may answer a batch more than once (``attempt`` numbers them).
STUDENT_KEYS = BATCH_KEYS + ["stu_code", "attempt"]

OBJECTIVE = "objective"
SUBJECTIVE = "subjective"

RESPONSES = T.StructType(
    [
        T.StructField("paper_code", T.StringType()),
        T.StructField("create_time", T.StringType()),
        T.StructField("stu_code", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("section", T.IntegerType()),
        T.StructField("item_id", T.IntegerType()),
        T.StructField("score", T.IntegerType()),
    ]
)

BLUEPRINT = T.StructType(
    [
        T.StructField("paper_code", T.StringType()),
        T.StructField("section", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("qty", T.IntegerType()),
        T.StructField("full_mark", T.IntegerType()),
    ]
)

ITEM_KNOWLEDGE = T.StructType(
    [
        T.StructField("paper_code", T.StringType()),
        T.StructField("kl_id", T.IntegerType()),
        T.StructField("item_id", T.IntegerType()),
    ]
)

# Result tables (wide types; ``itemstats.sinks.results.narrow`` gives the
# reference's decimal widths on request).
SCORE_TOTAL_COLUMNS = STUDENT_KEYS + ["total_score"]
ITEM_INDEX_COLUMNS = BATCH_KEYS + [
    "item_id", "max_score", "min_score", "avg_score", "fc_score", "bzc_score", "nandu", "qufendu",
]
PAPER_INDEX_COLUMNS = BATCH_KEYS + [
    "max_score", "min_score", "avg_score", "fc_score", "bzc_score", "nandu", "qufendu", "xindu",
]
ITEM_FPG_COLUMNS = BATCH_KEYS + ["pre_order", "suf_order", "confidence"]
ITEM_CLUSTER_COLUMNS = BATCH_KEYS + ["stu_code", "attempt", "good_item", "bad_item", "centers"]
