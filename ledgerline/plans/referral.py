"""Sign-ups that followed from being asked to sign someone else's document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.dates import local_time, recent_since
from ledgerline.functions.identity import contact_kind, mask_contact
from ledgerline.operators.matching import first_per
from ledgerline.operators.ordering import cut
from ledgerline.operators.passes import in_passes, passes_for
from ledgerline.sources.tables import COMPACT, append_new, conform, delete_matching, scan_entities, stage

# Entity kind, key prefix and roles of participants.
KIND = "Participant"
PREFIX = "Participant#"
ROLES = ("SIGNER", "VIEWER")

# Names of the source and of the stored table that are words of SQL, and ours.
BORDER = {"to": "due", "from": "viewed", "order": "ordinal"}

TOUCH = [
    "participantid",
    "requester_userid",
    "requester_workspaceid",
    "requester_estimated_workspaceid",
    "documentid",
    "contact",
    "contactinfo",
    "signingmethod",
    "signingat",
    "documentcreatedat",
]


def inside(df: DataFrame) -> DataFrame:
    """A source or stored table under the names used here."""
    return df.withColumnsRenamed(BORDER)


def participants_stage(items: DataFrame, as_of: Column) -> DataFrame:
    """Signers and viewers of documents from the last month's partitions."""
    rows = inside(scan_entities(items, KIND, recent_since(as_of)))
    return rows.where(F.col("type").isin(*ROLES) & F.col("documentid").isNotNull()).select(
        "documentid",
        F.split_part("entity", F.lit(PREFIX), F.lit(2)).alias("participantid"),
        "contact",
        "type",
        contact_kind(F.col("contact")).alias("contactinfo"),
        "signingmethod",
        "locale",
        F.try_to_timestamp("due").cast("timestamp_ntz").alias("due"),
        F.try_to_timestamp("viewed").cast("timestamp_ntz").alias("viewed"),
        F.col("signingduration").try_cast("bigint").alias("signingduration"),
        local_time(F.col("createdat")).alias("createdat"),
    )


def signing_order(rows: DataFrame) -> DataFrame:
    """Order to sign within a document: 1 for the earliest deadline, else the position by id.

    Rows are cut by range over the whole order and numbered within a document's
    share of each part, with the shares before it added, so a document of any
    size is spread over many tasks.
    """
    order = [
        F.asc_nulls_last("participantid"),
        F.asc_nulls_last("due"),
        F.asc_nulls_last("contact"),
        F.asc("_tie"),
    ]
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    stored = cut(tied, [F.asc("documentid"), *order], "signing-order", COMPACT)
    share = ["documentid", "_part"]
    shares = stored.groupBy(*share).agg(F.count(F.lit(1)).alias("_n"), F.min("due").alias("_due"))
    whole = W.partitionBy("documentid")
    before = whole.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shares = shares.select(
        *share,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.min("_due").over(whole).alias("_earliest"),
    )
    place = F.row_number().over(W.partitionBy(*share).orderBy(*order)) + F.col("_before")
    first = F.col("due").eqNullSafe(F.col("_earliest"))
    ordinal = F.when(first, F.lit(1).cast("bigint")).otherwise(place)
    return stored.join(shares, share).withColumn("ordinal", ordinal).select(*rows.columns, "ordinal")


STORED = [
    "documentid",
    "participantid",
    "contact",
    "type",
    "ordinal",
    "contactinfo",
    "signingmethod",
    "locale",
    "due",
    "viewed",
    "signingduration",
    "createdat",
]


_S, _B, _TS = T.StringType(), T.LongType(), T.TimestampNTZType()
_KINDS = {"order": _B, "signingduration": _B, "to": _TS, "from": _TS, "createdat": _TS}
_OUTSIDE = {ours: theirs for theirs, ours in BORDER.items()}

# Columns of the stored tables.
PARTICIPANT_SCHEMA = T.StructType(
    [T.StructField(name, _KINDS.get(name, _S)) for name in (_OUTSIDE.get(c, c) for c in STORED)]
)
USER = [
    "id",
    "idprovidertype",
    "profileemail",
    "profilename",
    "profilesurveybusinessregistrationnumber",
    "profilesurveycity",
    "profilesurveycompanycategory",
    "profilesurveycompanyid",
    "profilesurveycompanyname",
    "profilesurveycompanyscale",
    "profilesurveydepartment",
    "profilesurveyexpectedstarttime",
    "profilesurveyexpectedusage",
    "profilesurveyfunnel",
    "profilesurveyphonenumber",
    "profilesurveysearchword",
    "profilesurveyusertype",
    "activatedat",
    "createdat",
    "updatedat",
]
_TIMES = {"signingat", "documentcreatedat", "activatedat", "createdat", "updatedat"}
ATTRIBUTION_SCHEMA = T.StructType([T.StructField(name, _TS if name in _TIMES else _S) for name in [*TOUCH, *USER]])


def participants_table(rows: DataFrame) -> DataFrame:
    """Participants as the stored table has them."""
    return conform(rows.withColumnsRenamed(_OUTSIDE), PARTICIPANT_SCHEMA)


def attribution_table(rows: DataFrame) -> DataFrame:
    """Attributed users as the stored table has them; columns that are not known yet are NULL."""
    return conform(rows, ATTRIBUTION_SCHEMA)


def new_participants(staged: DataFrame, stored: DataFrame, passes: int | None = None) -> DataFrame:
    """Staged participants not stored yet, in order and with masked contacts."""

    def ordered(rows: DataFrame) -> DataFrame:
        masked = mask_contact(F.col("contact"), F.col("contactinfo"))
        return signing_order(rows).withColumn("contact", masked).select(*STORED)

    known = stored.select("participantid")
    return in_passes(
        lambda rows: ordered(append_new(rows, known, "participantid")),
        "documentid",
        passes or passes_for(staged),
        "participants-ordered",
        staged,
    )


def participants_delete(stored: DataFrame, staged: DataFrame) -> DataFrame:
    """Stored participants left after dropping those of documents that changed."""
    return delete_matching(inside(stored), staged, ["documentid"], "participantid")


def participants_refresh(stored: DataFrame, staged: DataFrame) -> DataFrame:
    """The stored table after the day's run.

    The result is stored, so it may replace ``stored``. Both steps read
    ``staged``: pass a staged frame. Large tables are refreshed in passes over
    the documents.
    """
    passes = passes_for(stored, staged)
    kept = in_passes(
        lambda rows, changed: participants_delete(rows, changed).select(*STORED),
        "documentid",
        passes,
        "participants-kept",
        inside(stored),
        staged,
    )
    rows = kept.unionByName(new_participants(staged, kept, passes))
    return rows if passes > 1 else stage(rows, "participants", COMPACT)


def first_touch(participants: DataFrame, documents: DataFrame, require_viewed: bool = False) -> DataFrame:
    """The first document each contact came to see, among those whose turn it was."""
    doc = documents.select(
        F.col("id").alias("documentid"),
        F.col("userid").alias("requester_userid"),
        F.col("workspaceid").alias("requester_workspaceid"),
        F.col("estimated_workspaceid").alias("requester_estimated_workspaceid"),
        F.col("createdat").alias("documentcreatedat"),
        "currentsigningorder",
    )
    seen = inside(participants).select(
        "participantid", "documentid", "contact", "contactinfo", "signingmethod", F.col("viewed").alias("signingat"), "ordinal"
    )
    if require_viewed:
        seen = seen.where(F.col("signingat").isNotNull())
    order = [F.asc_nulls_last("signingat"), F.asc_nulls_last("participantid")]
    passes = passes_for(seen, doc)

    def reached(rows: DataFrame, docs: DataFrame) -> DataFrame:
        return rows.join(docs, "documentid").where(F.col("currentsigningorder") >= F.col("ordinal")).select(*TOUCH)

    turns = in_passes(reached, "documentid", passes, "touches-reached", seen, doc)
    return in_passes(lambda rows: first_per(rows, ["contact"], order), "contact", passes, "first-touch", turns)


def match_either_key(touches: DataFrame, users: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pairs of touch and user, one for each key that equals the contact.

    A user is entered once under each key, so one join serves all keys.
    """
    keyed = users.withColumn("_contact", F.explode(F.array(*keys)))
    return touches.join(keyed, touches["contact"] == keyed["_contact"]).drop("_contact")


def referral_attribution(
    touches: DataFrame,
    users: DataFrame,
    test_user: DataFrame,
    attributed: DataFrame,
    keys: Sequence[str] = ("profilesurveyphonenumber", "profileemail"),
) -> DataFrame:
    """Users activated after their first touch, once each, not attributed before.

    A user found by phone and by mail takes the earlier touch, on a tie the mail.
    """
    real = users.join(test_user.select(F.col("userid").alias("id")), "id", "left_anti")
    pairs = match_either_key(touches, real, keys)
    mail_first = F.when(F.col("contactinfo") == "email", 1).otherwise(2)
    order = [F.asc_nulls_last("signingat"), mail_first, F.asc_nulls_last("participantid")]
    one = first_per(pairs, ["id"], order).where(F.col("activatedat") > F.col("signingat"))
    return append_new(one, attributed, "id").select(*TOUCH, *users.columns)
