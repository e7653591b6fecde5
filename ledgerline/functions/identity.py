"""Masked contacts and stable row ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contact_kind(contact: Column) -> Column:
    """``email`` when the contact holds a dot or an at sign, else ``kakao``."""
    return F.when(contact.contains(".") | contact.contains("@"), "email").otherwise("kakao")


def mask_contact(contact: Column, kind: Column) -> Column:
    """Hash the local part of a mail address, or the whole international number."""
    local = F.split_part(contact, F.lit("@"), F.lit(1))
    domain = F.split_part(contact, F.lit("@"), F.lit(2))
    phone = F.concat(F.lit("+82"), F.substring(contact, 2, 2**31 - 1))
    return F.when(kind == "email", F.concat(F.sha2(local, 256), F.lit("@"), domain)).when(
        kind == "kakao", F.sha2(phone, 256)
    )


def surrogate_id(*parts: Column) -> Column:
    """The same id for the same row in every run."""
    return F.md5(F.concat_ws("|", *parts))
