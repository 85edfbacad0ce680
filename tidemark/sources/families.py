"""The event families: wire schemas of their types, and a typed table of each."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ids import key_number, uuid7_time
from tidemark.sources.records import decode_envelope, route_by_type

# Names and types on the wire.
_META = "metadata map<string, string>"
_SLOTS = "schedule struct<slots: array<struct<daysOfWeek: array<string>, time: string, jitterMinutes: int>>>"
_PAID = "payments array<struct<currencyItemId: bigint, qty: bigint>>"
_PARAMS = "params map<string, string>"
_MOVED = "struct<itemTemplateId: bigint, itemId: bigint, newItemId: bigint, count: bigint, enchantLevel: int, attributes: map<string, int>>"
_PARTY = f"struct<charId: bigint, items: array<{_MOVED}>>"
_TRADED = "itemTemplateId: bigint, enchantLevel: int, attributes: map<string, int>, count: bigint, unitPrice: bigint, currencyItemTemplateId: bigint"
_ACTOR = "struct<charId: bigint, clanId: bigint, allyId: bigint, partyId: string, commandChannelId: string, partyLeader: boolean, commandChannelLeader: boolean, damageDealt: bigint>"
_AUGMENTATION = "struct<option1Id: int, option2Id: int>"
_COLON = lambda ddl: ddl.replace(" ", ": ", 1)  # noqa: E731  a column's DDL as a field's

#: family: type: fields besides eventId. A family is a topic that carries its types, told by a header.
FAMILIES: dict[str, dict[str, str]] = {
    "premiumpurchase": {
        "PremiumPurchaseEvent": f"characterId bigint, characterName string, accountName string, items array<struct<itemId: bigint, qty: bigint, {_COLON(_PARAMS)}, {_COLON(_PAID)}>>, services array<struct<code: string, qty: bigint, {_COLON(_PARAMS)}, {_COLON(_PAID)}>>, {_META}",
    },
    "serveronline": {
        "ServerOnlineSnapshotEvent": f"buckets map<string, bigint>, {_META}",
        "ServerStartedEvent": _META,
        "ServerStoppingEvent": _META,
    },
    "gameevents": {
        "GameEventSnapshotEvent": f"events array<struct<code: string, name: string, enabled: boolean, status: string, nextStartAt: timestamp, {_COLON(_META)}, {_COLON(_SLOTS)}>>, {_META}",
    },
    "privatestore": {
        "PrivateStorePurchaseEvent": f"storeType string, sellerId bigint, sellerName string, buyerId bigint, buyerName string, lines array<struct<{_TRADED}>>, {_META}",
        "PrivateStoreStateEvent": f"charId bigint, store struct<type: string, title: string, offline: boolean, lines: array<struct<itemId: bigint, {_TRADED}>>>, {_META}",
    },
    "character": {
        "CharacterPresenceEvent": f"charId bigint, online boolean, source string, activity string, resumed boolean, logoutReason string, sessionId string, accountName string, ip string, hwid string, {_META}",
        "CharacterDeathEvent": f"charId bigint, {_META}",
    },
    "characterlog": {"CharacterLogEvent": f"charId bigint, type string, {_META}"},
    "raid": {
        "RaidKillEvent": f"bossNpcId int, bossName string, bossLevel int, instanceId bigint, lastHit {_ACTOR}, dropOwner {_ACTOR}, participants array<{_ACTOR}>, drops array<struct<itemId: int, count: bigint, enchantLevel: int>>, {_META}",
        "BossRespawnSnapshotEvent": f"bosses array<struct<npcId: int, level: int, status: string, nextRespawnAt: timestamp, {_COLON(_META)}, {_COLON(_SLOTS)}>>, {_META}",
    },
    "castle": {
        "CastleSnapshotEvent": f"castles array<struct<castleId: int, name: string, ownerClanId: bigint, nextSiegeAt: timestamp, registrationEndsAt: timestamp, siegeEndsAt: timestamp, {_COLON(_META)}, {_COLON(_SLOTS)}>>, {_META}",
        "SiegeFinishedEvent": f"castleId int, castleName string, siegeStartedAt timestamp, outcome string, winnerClanId bigint, attackerClanIds array<bigint>, defenderClanIds array<bigint>, {_META}",
    },
    "mail": {
        "MailSentEvent": f"mailId bigint, senderCharId bigint, senderName string, receiverCharId bigint, subject string, body string, expiresAt timestamp, codAmount bigint, attachments array<{_MOVED}>, {_META}",
        "MailAcceptedEvent": f"mailId bigint, claimedByCharId bigint, attachments array<{_MOVED}>, {_META}",
        "MailCancelledEvent": f"mailId bigint, cancelledByCharId bigint, attachments array<{_MOVED}>, {_META}",
        "MailReturnedEvent": f"mailId bigint, returnedToSenderId bigint, attachments array<{_MOVED}>, {_META}",
        "MailReadEvent": "mailId bigint",
        "MailDeletedEvent": "mailId bigint, side string",
    },
    "privatetrade": {"PrivateTradeFinishedEvent": f"tradeId string, partyA {_PARTY}, partyB {_PARTY}, {_META}"},
    "olympiad": {
        "OlympiadMatchResultEvent": f"matchId string, olympiadCycle int, gameType string, charId bigint, classId int, clazz string, clanId bigint, opponentCharId bigint, opponentClassId int, opponentClazz string, opponentClanId bigint, result string, reason string, pointsBefore int, pointsAfter int, damageDealt int, opponentDamageDealt int, fightStartedAt timestamp, fightDurationSec bigint, {_META}",
        "HeroGrantedEvent": f"charId bigint, classId int, clazz string, clanId bigint, olympiadCycle int, {_META}",
    },
    "sync": {"ResyncCompletedEvent": "resyncId string, entityName string, cycleStartedAt timestamp, completedAt timestamp"},
    "chat": {
        "ChatMessageEvent": f"charId bigint, charName string, channel string, text string, targetCharId bigint, targetCharName string, {_META}, senderDisplayName string, recipientCharacterIds array<bigint>, items array<struct<itemObjectId: bigint, itemTemplateId: int, enchantLevel: int, attributes: map<string, int>, augmentation: {_AUGMENTATION}, count: bigint>>",
    },
    "account": {
        "AccountAuthAttemptEvent": f"serverId string, accountName string, clientIp string, hwid string, outcome string, attemptedAt timestamp, failureDetail string, {_META}",
    },
}
#: The payload field that a type is keyed by; the others are dealt round-robin.
KEYS: dict[str, str] = {
    "PremiumPurchaseEvent": "characterId",
    "RaidKillEvent": "bossNpcId",
    "SiegeFinishedEvent": "castleId",
    "AccountAuthAttemptEvent": "accountName",
} | {t: f for f in ("mailId", "charId") for types in FAMILIES.values() for t, ddl in types.items() if ddl.startswith(f)}


def family_tables(records: DataFrame, family: str, types: Mapping[str, str] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """({type: table}, dead letters) of the records of a family's topic. A table has msg_type, event_id, event_time (the
    instant inside the id), key_number (null for keys that aren't numbers) and the payload as its schema has it;
    fields on the wire that it doesn't know are ignored, types that it doesn't know are in no table."""
    types = FAMILIES[family] if types is None else types
    routed, tables, dead = route_by_type(records, list(types)), {}, None
    for kind, ddl in types.items():
        good, bad = decode_envelope(routed.where(F.col("msg_type") == kind), f"eventId string, {ddl}")
        event_id = F.col("payload.eventId")
        tables[kind] = good.select("msg_type", event_id.alias("event_id"), uuid7_time(event_id).alias("event_time"), key_number(F.col("key")).alias("key_number"), "payload")
        bad = bad.select("msg_type", "key", "value")
        dead = bad if dead is None else dead.unionByName(bad)
    return tables, dead
