"""Record layouts of the envelope, the facts, the dimensions and the wide row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Topic names, the prefix of the second-layer topics.
DIM_TOPICS = ("basead", "basewebsite", "membervip")
FACT_TOPICS = ("member", "memberregtype", "memberpaymoney")
SECOND_LAYER_PREFIX = "dwd"

ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)


@dataclass(frozen=True)
class RecordSpec:
    """Fields of one JSON record; every field travels as text on the wire."""

    topic: str
    fields: tuple[str, ...]
    ints: tuple[str, ...]
    key: tuple[str, ...]
    event_time: str | None = None

    @property
    def wire_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f, T.StringType()) for f in self.fields])


# Field names of the records.
MEMBER = RecordSpec(
    topic="member",
    fields=(
        "uid", "ad_id", "birthday", "email", "fullname", "iconurl", "lastlogin",
        "mailaddr", "memberlevel", "password", "paymoney", "phone", "qq", "register",
        "regupdatetime", "unitname", "userip", "zipcode", "dt", "dn",
    ),
    ints=("uid", "ad_id"),
    key=("uid", "dn"),
    event_time="register",
)
REGTYPE = RecordSpec(
    topic="memberregtype",
    fields=(
        "uid", "appkey", "appregurl", "bdp_uuid", "createtime", "isranreg",
        "regsource", "websiteid", "dt", "dn",
    ),
    ints=("uid",),
    key=("uid", "dn"),
    event_time="createtime",
)
PAYMONEY = RecordSpec(
    topic="memberpaymoney",
    fields=("uid", "paymoney", "siteid", "vip_id", "createtime", "dt", "dn"),
    ints=("uid", "siteid", "vip_id"),
    key=("uid", "dn"),
    event_time="createtime",
)
BASE_AD = RecordSpec(
    topic="basead", fields=("adid", "adname", "dn"), ints=("adid",), key=("adid", "dn")
)
BASE_SITE = RecordSpec(
    topic="basewebsite",
    fields=("siteid", "sitename", "siteurl", "delete", "createtime", "creator", "dn"),
    ints=("siteid",),
    key=("siteid", "dn"),
)
BASE_VIP = RecordSpec(
    topic="membervip",
    fields=(
        "vip_id", "vip_level", "start_time", "end_time", "last_modify_time",
        "max_free", "min_free", "next_level", "operator", "dn",
    ),
    ints=("vip_id",),
    key=("vip_id", "dn"),
)
RECORDS = {r.topic: r for r in (MEMBER, REGTYPE, PAYMONEY, BASE_AD, BASE_SITE, BASE_VIP)}

# Fields that the fact join carries on, by side.
MEMBER_COLUMNS = (
    "ad_id", "birthday", "email", "fullname", "iconurl", "lastlogin", "mailaddr",
    "memberlevel", "password", "phone", "qq", "register", "regupdatetime",
    "unitname", "userip", "zipcode", "dt",
)
REGTYPE_COLUMNS = (
    "appkey", "appregurl", "bdp_uuid", "createtime", "isranreg", "regsource", "websiteid",
)
PAYMONEY_COLUMNS = ("paymoney", "siteid", "vip_id")

# The stored wide member row, (name, source column, type).
WIDE_COLUMNS = (
    ("id", "id", "string"),
    ("uid", "uid", "int"),
    ("ad_id", "ad_id", "int"),
    ("fullname", "fullname", "string"),
    ("iconurl", "iconurl", "string"),
    ("mailaddr", "mailaddr", "string"),
    ("memberlevel", "memberlevel", "string"),
    ("password", "password", "string"),
    ("phone", "phone", "string"),
    ("qq", "qq", "string"),
    ("register", "register", "string"),
    ("regupdatetime", "regupdatetime", "string"),
    ("unitname", "unitname", "string"),
    ("userip", "userip", "string"),
    ("zipcode", "zipcode", "string"),
    ("appkey", "appkey", "string"),
    ("appregurl", "appregurl", "string"),
    ("bdp_uuid", "bdp_uuid", "string"),
    ("regsource", "regsource", "string"),
    ("adname", "adname", "string"),
    ("siteid", "siteid", "int"),
    ("sitename", "sitename", "string"),
    ("siteurl", "siteurl", "string"),
    ("site_delete", "delete", "string"),
    ("site_createtime", "site_createtime", "string"),
    ("site_creator", "site_creator", "string"),
    ("vip_id", "vip_id", "int"),
    ("vip_level", "vip_level", "string"),
    ("vip_start_time", "vip_start_time", "timestamp"),
    ("vip_end_time", "vip_end_time", "timestamp"),
    ("vip_last_modify_time", "last_modify_time", "timestamp"),
    ("vip_max_free", "max_free", "string"),
    ("vip_min_free", "min_free", "string"),
    ("vip_operator", "operator", "string"),
    ("paymoney", "paymoney", "decimal(18,2)"),
    ("dt", "dt", "string"),
    ("dn", "dn", "string"),
)

# The full member record with every looked-up field.
FULL_COLUMNS = (
    "uid", "ad_id", "birthday", "email", "fullname", "iconurl", "lastlogin", "mailaddr",
    "memberlevel", "password", "phone", "qq", "register", "regupdatetime", "unitname",
    "userip", "zipcode", "appkey", "appregurl", "bdp_uuid", "regtype_createtime",
    "isranreg", "regsource", "websiteid", "adname", "siteid", "sitename", "siteurl",
    "site_createtime", "paymoney", "vip_id", "vip_level", "vip_start_time",
    "vip_end_time", "last_modify_time", "max_free", "min_free", "next_level",
    "operator", "dn", "dt",
)
