"""SQL spelling of the roles, shared by the oracle queries."""

FACTS = """
ev AS (
  SELECT event_id, user_id, event_type, value, props, ts,
         'web' || substr('ABC', CAST(user_id % 3 AS INTEGER) + 1, 1) AS dn,
         CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ms,
         strftime(ts, '%Y%m%d') AS dt,
         CAST(date_trunc('day', ts) AS TIMESTAMP) AS win
  FROM events),
member AS (
  SELECT CAST(user_id AS INTEGER) AS uid, CAST(user_id % 30 AS INTEGER) AS ad_id,
         strftime(DATE '1960-01-01' + CAST(user_id * 37 % 14610 AS INTEGER), '%Y-%m-%d') AS birthday,
         'u' || user_id || '@example.org' AS email, '成员' || user_id AS fullname,
         '-' AS iconurl, '-' AS lastlogin, '-' AS mailaddr,
         CAST(user_id % 8 + 1 AS VARCHAR) AS memberlevel, '-' AS password, '-' AS phone,
         '-' AS qq, ms AS register, '-' AS regupdatetime, '-' AS unitname,
         ((user_id + 607649792) >> 24) || '.' || (((user_id + 607649792) >> 16) & 255) || '.'
           || (((user_id + 607649792) >> 8) & 255) || '.' || ((user_id + 607649792) & 255) AS userip,
         '-' AS zipcode, dt, dn, event_id AS member_seq, win
  FROM ev WHERE event_type = 'signup'),
regtype AS (
  SELECT CAST(user_id AS INTEGER) AS uid, '-' AS appkey, 'u' || event_id AS appregurl,
         '-' AS bdp_uuid, ms AS createtime, '-' AS isranreg,
         CAST(event_id % 5 AS VARCHAR) AS regsource, CAST(user_id % 5 AS VARCHAR) AS websiteid,
         dt, dn, event_id AS regtype_seq, win
  FROM ev WHERE event_type = 'view'),
pay AS (
  SELECT CAST(user_id AS INTEGER) AS uid, printf('%.2f', value) AS paymoney,
         CAST(user_id % 110 AS INTEGER) AS siteid, CAST(event_id % 6 AS INTEGER) AS vip_id,
         ms AS createtime, dt, dn, event_id AS paymoney_seq, win
  FROM ev WHERE event_type = 'purchase')
"""

DIMS = """
sites2 AS (SELECT unnest(['webA', 'webB']) AS dn, unnest([0, 1]) AS pos),
ad AS (
  SELECT CAST(n_nationkey AS INTEGER) AS adid, n_name AS adname, dn,
         CAST(n_nationkey AS BIGINT) * 2 + pos AS seq
  FROM nation, sites2),
site AS (
  SELECT CAST(s_suppkey AS INTEGER) AS siteid, s_name AS sitename, s_name || '/' || dn AS siteurl,
         '0' AS "delete", '2000-01-01' AS createtime, 'admin' AS creator, dn,
         CAST(s_suppkey AS BIGINT) * 2 + pos AS seq
  FROM supplier, sites2),
vip AS (
  SELECT CAST(r_regionkey AS INTEGER) AS vip_id, r_name AS vip_level,
         strftime(DATE '2015-01-01' + CAST(r_regionkey AS INTEGER), '%Y-%m-%d') || ' 00:00:00' AS start_time,
         strftime(DATE '2016-01-01' + CAST(r_regionkey AS INTEGER), '%Y-%m-%d') || ' 12:30:00' AS end_time,
         strftime(DATE '2019-06-01' + CAST(r_regionkey AS INTEGER), '%Y-%m-%d') || ' 08:15:30' AS last_modify_time,
         '-' AS max_free, '-' AS min_free, '-' AS next_level, 'update' AS operator, dn,
         CAST(r_regionkey AS BIGINT) * 2 + pos AS seq
  FROM region, sites2)
"""

# The joined facts, in both multiplicities.
LEFT_OUTER = """
j1 AS (
  SELECT m.*, r.appkey, r.appregurl, r.bdp_uuid, r.createtime, r.isranreg, r.regsource,
         r.websiteid, r.regtype_seq
  FROM member m LEFT JOIN regtype r ON m.uid = r.uid AND m.dn = r.dn AND m.win = r.win),
j2 AS (
  SELECT j1.*, p.paymoney, p.siteid, p.vip_id, p.paymoney_seq
  FROM j1 LEFT JOIN pay p ON j1.uid = p.uid AND j1.dn = p.dn AND j1.win = p.win)
"""

FIRST_LEFT = """
m1 AS (
  SELECT *, row_number() OVER (PARTITION BY uid, dn, win ORDER BY member_seq) AS rn FROM member),
f1 AS (
  SELECT m1.* EXCLUDE (rn), r.appkey, r.appregurl, r.bdp_uuid, r.createtime, r.isranreg,
         r.regsource, r.websiteid, r.regtype_seq
  FROM m1 LEFT JOIN regtype r ON m1.uid = r.uid AND m1.dn = r.dn AND m1.win = r.win
  WHERE m1.rn = 1 OR r.uid IS NULL),
f1n AS (
  SELECT *, row_number() OVER (
    PARTITION BY uid, dn, win ORDER BY member_seq, regtype_seq) AS rn FROM f1),
f2 AS (
  SELECT f1n.* EXCLUDE (rn), p.paymoney, p.siteid, p.vip_id, p.paymoney_seq
  FROM f1n LEFT JOIN pay p ON f1n.uid = p.uid AND f1n.dn = p.dn AND f1n.win = p.win
  WHERE f1n.rn = 1 OR p.uid IS NULL)
"""


def looked_up(joined: str) -> str:
    """SQL of the three lookups on a joined relation, as relation ``e``."""
    return f"""
e AS (
  SELECT j.*, a.adname, s.sitename, s.siteurl, s."delete", s.createtime AS site_createtime,
         s.creator AS site_creator, v.vip_level, v.start_time AS vip_start_time,
         v.end_time AS vip_end_time, v.last_modify_time, v.max_free, v.min_free, v.next_level,
         v.operator
  FROM {joined} j
  LEFT JOIN ad a ON j.ad_id = a.adid AND j.dn = a.dn
  LEFT JOIN site s ON j.siteid = s.siteid AND j.dn = s.dn
  LEFT JOIN vip v ON j.vip_id = v.vip_id AND j.dn = v.dn)
"""


WIDE_SELECT = """
  substr(md5(CAST(uid AS VARCHAR)), 1, 5) || uid || dn AS id, uid, ad_id, fullname, iconurl,
  mailaddr, memberlevel, password, phone, qq, register, regupdatetime, unitname, userip,
  zipcode, appkey, appregurl, bdp_uuid, regsource, adname, siteid, sitename, siteurl,
  "delete" AS site_delete, site_createtime, site_creator, vip_id, vip_level,
  CAST(vip_start_time AS TIMESTAMP) AS vip_start_time,
  CAST(vip_end_time AS TIMESTAMP) AS vip_end_time,
  CAST(last_modify_time AS TIMESTAMP) AS vip_last_modify_time, max_free AS vip_max_free,
  min_free AS vip_min_free, operator AS vip_operator, CAST(paymoney AS DECIMAL(18,2)) AS paymoney,
  dt, dn
"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n"
