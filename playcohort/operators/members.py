"""Members, cards and account extracts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playcohort.functions.money import gross_amount
from playcohort.operators.cohort import first_registration
from playcohort.operators.kpi import count_distinct
from playcohort.operators.merge import delete_where, merge_replace


def card_accounts(regi: DataFrame, promo_user: DataFrame, login: DataFrame, games: DataFrame, day: dt.date) -> DataFrame:
    """Card accounts registered on a day, with owner, game and last login.

    The day's accounts restrict the logins before these are aggregated.
    """
    today = regi.filter((F.to_date("relate_time") == F.lit(day)) & (F.col("owner_id") != 0) & F.col("game_account").isNotNull())
    last = login.join(today.select("game_account").distinct(), "game_account", "left_semi").groupBy("game_account").agg(
        F.max("login_time").alias("last_login_time"))
    return (
        today.join(promo_user.select(F.col("member_id").alias("owner_id"), "username"), "owner_id")
        .join(last, "game_account", "left").join(games.select(F.col("id").alias("game_id"), "mainid", "maingname"), "game_id")
        .select(
            "game_account", F.col("owner_id").alias("uid"), F.coalesce("mainid", F.lit(0)).alias("game_id"),
            F.coalesce("maingname", F.lit("")).alias("game_name"),
            F.when(F.col("reg_resource") == 1, 1).otherwise(2).alias("user_type"), F.col("relate_time").alias("regi_time"),
            "last_login_time", F.when(F.col("bind_uid_time").isNull(), 0).otherwise(1).alias("is_recharge"),
            F.coalesce("username", F.lit("")).alias("user_account"), F.coalesce("reg_os_type", F.lit("UNKNOW")).alias("platform"))
    )


def card_extension(regi: DataFrame, promo_user: DataFrame, games: DataFrame, day: dt.date) -> DataFrame:
    """Bound and registered card accounts of a day per (owner, game, os): two counts added side by side."""
    def branch(time: str, name: str, other: str) -> DataFrame:
        rows = regi.filter(F.to_date(time) == F.lit(day))
        return rows.groupBy("owner_id", "game_id", "reg_os_type", F.to_date(time).alias("day")).agg(
            F.count("game_account").alias(name)).withColumn(other, F.lit(0).cast("long"))

    both = branch("bind_uid_time", "add_users", "regi_accounts").unionByName(branch("relate_time", "regi_accounts", "add_users"))
    owners = promo_user.filter("member_grade = 1 AND status IN (0, 1)").select(F.col("member_id").alias("owner_id"), "username")
    named = both.join(games.select(F.col("id").alias("game_id"), "mainid", "maingname"), "game_id").join(owners, "owner_id")
    return named.groupBy(
        "day", F.coalesce("username", F.lit("")).alias("user_account"), F.coalesce("mainid", F.lit(0)).alias("game_id"),
        F.coalesce("maingname", F.lit("")).alias("game_name"), F.coalesce("reg_os_type", F.lit("UNKNOW")).alias("os"),
    ).agg(F.sum("add_users").alias("add_users"), F.sum("regi_accounts").alias("regi_accounts"))


def member_history(members: DataFrame, bindings: DataFrame, orders: DataFrame, until: dt.date) -> DataFrame:
    """Members with their account count and order statistics; rows without name and date are removed.

    ``orders``: userid, orderid, oriprice, productnum, payprice, erectime, state.
    """
    last = F.lit(until)
    base = members.filter(F.to_date("addtime") <= last)
    accounts = count_distinct(bindings.filter(F.to_date("bind_time") <= last), ["member_id"], ["account"], "accounts")
    paid = orders.filter((F.col("state") == 4) & (F.col("userid") != 0) & (F.to_date("erectime") <= last))
    # orders per (member, order) first, so that counting distinct orders is a plain count
    per_order = paid.groupBy("userid", "orderid").agg(
        F.sum(F.col("oriprice") * F.col("productnum")).alias("oriprice"), F.sum("payprice").alias("payprice"), F.max("erectime").alias("t"))
    stats = per_order.groupBy(F.col("userid").alias("member_id")).agg(
        F.count(F.lit(1)).alias("ordernum"), F.sum("oriprice").alias("oriprice"), F.sum("payprice").alias("payprice"),
        F.max("t").alias("last_pay_time"))
    empty = base.select(
        "*", F.lit(None).cast("long").alias("accounts"), F.lit(None).cast("long").alias("ordernum"),
        *[F.lit(None).cast(stats.schema[c].dataType).alias(c) for c in ("oriprice", "payprice", "last_pay_time")])
    merged = merge_replace(merge_replace(empty, accounts, ["member_id"]), stats, ["member_id"])
    return delete_where(merged, F.col("username").isNull() | ((F.col("username") == "") & F.col("addtime").isNull()))


def account_extract(regi: DataFrame, logins: DataFrame, orders: DataFrame, accounts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Accounts of the wanted partners: first registration, lifetime amount, first channel, last login.

    The wanted accounts restrict every fact before it is aggregated; first and last rows come from
    min/max by time, equal times from the least channel and the greatest address.
    """
    keep = accounts.join(wanted.select("cp_uid").distinct(), "cp_uid", "left_semi").select(F.col("account").alias("game_account")).distinct()
    base = first_registration(regi.join(keep, "game_account", "left_semi"), ["game_account"])
    money = orders.join(keep, "game_account", "left_semi").select(
        "order_no", "order_time", "game_account", "game_id", "payment_type", "order_status",
        gross_amount(F.col("ori_price"), F.col("total_amt")).alias("amount")).distinct().groupBy("game_account").agg(
        F.sum("amount").alias("amount"))
    seen = logins.join(keep, "game_account", "left_semi").groupBy("game_account").agg(
        F.min(F.struct("login_time", "channel_expand")).alias("f"), F.max(F.struct("login_time", "ip")).alias("l"))
    return base.join(money, "game_account", "left").join(seen, "game_account", "left").select(
        "game_account", "reg_time", "amount", F.col("f.channel_expand").alias("first_channel"), F.col("l.ip").alias("last_ip"),
        F.col("l.login_time").alias("last_login_time"))


def repair_missing(master: DataFrame, special: DataFrame, accounts: DataFrame, promo_user: DataFrame, member: DataFrame) -> DataFrame:
    """Card sub-accounts the master lacks, completed from account, promoter and bound member."""
    missing = special.join(master.select("account"), "account", "left_anti")
    return (
        missing.join(accounts.select("account", "addtime", "imei", "game_id", "uid", "bind_member_id"), "account")
        .join(promo_user.select(F.col("member_id").alias("uid"), "code", "username", "group_id", "create_time"), "uid")
        .join(member.select(F.col("id").alias("bind_member_id"), F.col("username").alias("bind_member")), "bind_member_id", "left")
        .select(
            F.col("account").alias("game_account"), "game_id", F.col("addtime").alias("regi_time"), F.to_date("addtime").alias("regi_date"),
            "imei", F.col("code").alias("promo_code"), F.col("subordinate_code").alias("user_code"),
            F.concat_ws("~", "code", "subordinate_code").alias("pkg_code"), F.col("uid").alias("member_id"),
            F.col("username").alias("member_name"), "group_id", F.col("create_time").alias("member_regi_time"),
            F.coalesce("bind_member", F.lit("")).alias("bind_member"))
    )


def complete_accounts(seen: DataFrame, master: DataFrame, accounts: DataFrame) -> DataFrame:
    """Accounts that logs mention and the master lacks, from the account table, gaps filled with defaults."""
    missing = seen.select("account").distinct().join(master.select("account"), "account", "left_anti")
    return accounts.join(missing, "account", "left_semi").select(
        F.lower(F.trim("account")).alias("game_account"), F.coalesce("game_id", F.lit(0)).alias("game_id"), F.col("addtime").alias("reg_time"),
        F.coalesce("uid", F.lit(0)).alias("owner_id"), F.coalesce("bind_member_id", F.lit(0)).alias("bind_member_id"))


def complete_members(completed: DataFrame, known: DataFrame, member: DataFrame, promo_user: DataFrame) -> DataFrame:
    """Owners of completed accounts that the member dimension lacks, with their promotion code and grade."""
    owners = completed.filter("owner_id <> 0").select(F.col("owner_id").alias("member_id")).distinct()
    missing = owners.join(known.select("member_id"), "member_id", "left_anti")
    rows = member.select(F.col("id").alias("member_id"), F.coalesce("username", F.lit("")).alias("username")).join(missing, "member_id", "left_semi")
    promo = promo_user.select("member_id", "member_grade", "code")
    return rows.join(promo, "member_id", "left").select(
        "member_id", "username", F.coalesce(F.col("member_grade").cast("string"), F.lit("")).alias("grade"), F.coalesce("code", F.lit("0")).alias("promo_code"))


def package_stats(repaired: DataFrame) -> DataFrame:
    """Registered accounts and devices per (day, package, game): one per repaired account."""
    return repaired.groupBy("regi_date", "pkg_code", "promo_code", "user_code", "member_id", "member_name", "game_id").agg(
        F.count(F.lit(1)).alias("regi_accounts"), F.count(F.lit(1)).alias("regi_devs"))
