"""Identifiers: time-ordered UUIDs, record keys and their bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def uuid7_millis(c: Column) -> Column:
    """Epoch milliseconds of a version 7 UUID; null stays null, another version is an error."""
    bare = F.replace(c, F.lit("-"), F.lit(""))
    millis = F.conv(F.substring(bare, 1, 12), 16, 10).cast("bigint")
    return F.when(F.substring(bare, 13, 1) == "7", millis).when(c.isNotNull(), F.raise_error(F.concat(F.lit("not a version 7 UUID: "), c)).cast("bigint"))


def uuid7_time(c: Column) -> Column:
    return F.timestamp_millis(uuid7_millis(c))


def uuid7_at(millis: Column, *seed: Column) -> Column:
    """A version 7 UUID for an instant whose other bits come from ``seed``: equal inputs give equal ids, so a rerun
    repeats them. Instants outside 48 bits are an error."""
    sound = F.when(millis.between(0, (1 << 48) - 1), millis).otherwise(F.raise_error(F.lit("instant out of range")).cast("bigint"))
    time = F.lower(F.lpad(F.hex(sound), 12, "0"))
    rest = F.md5(F.concat_ws(":", millis.cast("string"), *[s.cast("string") for s in seed]))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(rest, 4, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat_ws("-", F.substring(time, 1, 8), F.substring(time, 9, 4), F.concat(F.lit("7"), F.substring(rest, 1, 3)), F.concat(variant, F.substring(rest, 5, 3)), F.substring(rest, 8, 12))


def uuid_or_null(c: Column) -> Column:
    """The trimmed UUID; null for blank text and for what is no UUID."""
    bare = F.trim(c)
    return F.when(bare.rlike(UUID), bare)


def key_bytes(pk: Column) -> Column:
    """Eight bytes, big-endian."""
    return F.unhex(F.lpad(F.hex(pk.cast("bigint")), 16, "0"))


def key_number(b: Column) -> Column:
    """The number of :func:`key_bytes`; null unless there are eight bytes."""
    high, low = (F.conv(F.substring(F.hex(b), k, 8), 16, 10).cast("bigint") for k in (1, 9))
    return F.when(F.octet_length(b) == 8, F.shiftleft(high, 32).bitwiseOR(low))


def uuid_bytes(c: Column) -> Column:
    return F.unhex(F.replace(c, F.lit("-"), F.lit("")))


def uuid_text(b: Column) -> Column:
    return F.when(F.octet_length(b) == 16, F.regexp_replace(F.lower(F.hex(b)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


#: Families whose records are keyed: by a number field, by nothing, or by the account's name.
ROUND_ROBIN = ("ServerOnlineSnapshotEvent", "ServerStartedEvent", "ServerStoppingEvent", "GameEventSnapshotEvent", "PrivateStorePurchaseEvent", "BossRespawnSnapshotEvent", "CastleSnapshotEvent", "PrivateTradeFinishedEvent", "ResyncCompletedEvent")
NUMBER_KEYS = {"RaidKillEvent": "npc_id", "SiegeFinishedEvent": "castle_id"} | dict.fromkeys(("MailSentEvent", "MailAcceptedEvent", "MailCancelledEvent", "MailReturnedEvent", "MailReadEvent", "MailDeletedEvent"), "mail_id")


def partition_key(msg_type: Column, fields: dict[str, Column]) -> Column:
    """Record key by message type: an id as eight bytes, none for the round-robin types, or the lower-cased account
    name. ``fields`` holds the columns char_id, npc_id, castle_id, mail_id and account_name that there are."""
    none = F.lit(None).cast("binary")
    out = F.when(msg_type.isin(*ROUND_ROBIN), none)
    for kind, field in NUMBER_KEYS.items():
        if field in fields:
            out = out.when(msg_type == kind, key_bytes(fields[field]))
    if "account_name" in fields:
        out = out.when(msg_type == "AccountAuthAttemptEvent", F.encode(F.lower(fields["account_name"]), "utf-8"))
    return out.otherwise(key_bytes(fields["char_id"]) if "char_id" in fields else none)
