"""Raw, all-text source extracts over the star tables.

The driver's tables are clean and typed; the workshop's systems deliver text.
Each function here turns a whole star table into one extract whose values need
exactly the cleaning that the rules in ``functions.clean`` promise: several
spellings of one value, units, separators, sentinels, unreadable values and
change events.  Which spelling a row gets depends on its key only.  What the
cleaned value must be is stated in ``plans.duck_sql`` from the star tables
alone, so the oracle never sees an extract.

orders -> work orders, invoices, payments; lineitem -> order lines and stock
movements; supplier -> technicians; part -> parts; customer -> customers and
vehicles; events -> telematics.  Dates move 25 years on, into the VAT table.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.sources import seeds

YEARS_ON = 25
#: Orders of customers and vehicles that no master table has.
STRANGER = 90_000_000
UNKNOWN_SERVICE_CODE = "XXX-999"


# ------------------------------------------------------------ text building
def form(idx: Column, *options) -> Column:
    """The option whose place is ``idx`` modulo their number (only that one is evaluated)."""
    place = idx % len(options)
    out = None
    for k, o in enumerate(options[:-1]):
        out = F.when(place == k, o) if out is None else out.when(place == k, o)
    return out.otherwise(options[-1])


def padded(number: Column, width: int) -> Column:
    """``%0{width}d`` of a whole number; the formatter itself, several times as slow, only where
    there is a sign or a null."""
    n = number.cast("bigint")
    text = n.cast("string")
    return F.when(n < 0, F.format_string(f"%0{width}d", n)).when(n.isNull(), F.format_string(f"%0{width}d", n)).otherwise(
        F.when(n >= 10 ** (width - 1), text).otherwise(F.lpad(text, width, "0")))


def div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("bigint")


def moved(ts: Column) -> Column:
    return F.timestamp_add("YEAR", F.lit(YEARS_ON), ts)


def time_text(ts: Column, idx: Column) -> Column:
    """Day only (the time is lost), ISO, epoch milliseconds."""
    return form(idx, F.date_format(ts, "dd/MM/yyyy"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
                F.lpad(F.unix_millis(ts.cast("timestamp")).cast("string"), 13, "0"))


def money_text(amount: Column, idx: Column) -> Column:
    """An amount with two decimals as a decimal comma, with a code or sign, grouped or padded."""
    plain, grouped = amount.cast("string"), F.format_number(amount, 2)
    return form(idx, F.translate(plain, ".", ","), F.concat(grouped, F.lit(" NGN")), F.concat(F.lit("₦"), grouped),
                F.concat(F.lit("ngn "), plain), F.concat(F.lit("   "), plain, F.lit(" ")))


def quarter_text(quarters: Column) -> Column:
    """A number of quarters with two decimals."""
    return F.concat(div(quarters, 4).cast("string"), F.lit("."), padded((quarters % 4) * 25, 2))


def vin_text(c: Column) -> Column:
    """A vehicle's 17 characters: maker and plant, check digit, eight digits of
    the number.  Every fiftieth has a wrong check digit."""
    digits = [div(c, 10 ** p) % 10 for p in range(7, -1, -1)]
    total = F.lit(137)  # the fixed eight characters 1HGCM000
    for d, weight in zip(digits, range(9, 1, -1)):
        total = total + d * weight
    check = F.when(total % 11 == 10, F.lit("X")).otherwise((total % 11).cast("string"))
    check = F.when(c % 50 == 7, F.lit("Z")).otherwise(check)
    return F.concat(F.lit("1HGCM000"), check, padded(c % 10 ** 8, 8))


def customer_code(c: Column) -> Column:
    return F.concat(F.lit("CUST-"), padded(c, 6))


def legacy_customer_id(c: Column) -> Column:
    return F.concat(F.lit("L"), padded(c, 5))


PHONE_PREFIXES = ("803", "706", "905", "812", "602")  # 602 is no mobile prefix


def phone_text(c: Column) -> Column:
    """Bracketed, spaced, international and local spellings of a number."""
    prefix, rest = form(c, *PHONE_PREFIXES), padded((c * 7919) % 10_000_000, 7)
    local = F.concat(F.lit("0"), prefix, rest)
    return form(div(c, 5), F.concat(F.lit("(0"), prefix, F.lit(") "), rest),
                F.concat(F.lit("0"), prefix, F.lit(" "), F.substring(rest, 1, 3), F.lit("-"), F.substring(rest, 4, 4)),
                F.concat(F.lit("+234 "), prefix, rest), local)


# -------------------------------------------------------------- work orders
def opened_ts(k: Column, orderdate: Column) -> Column:
    return F.timestamp_add("MINUTE", ((k * 37) % 1440).cast("int"), moved(orderdate))


def closed_ts(k: Column, c: Column, opened: Column) -> Column:
    return F.timestamp_add("MINUTE", ((c * 13 + k) % 9000).cast("int"), opened)


def work_orders_raw(orders: DataFrame) -> DataFrame:
    """dms.work_orders: change events of every order (created, changed a day
    later unless still open, and for a few orders deleted a day after that)."""
    k, c, state = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")

    def step(op: str, days: int) -> Column:
        return F.struct(F.lit(op).alias("op"), F.lit(days).alias("days"))

    steps = F.array_compact(F.array(step("I", 0), F.when(state != "O", step("U", 1)), F.when(k % 251 == 9, step("D", 2))))
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", steps.alias("steps"))
    who = c + F.when(k % 101 == 3, F.lit(STRANGER)).otherwise(F.lit(0))
    # what several columns use is computed once, before the events fan out
    o = o.select("*", who.alias("who"), vin_text(who).alias("vin"), opened_ts(k, F.col("o_orderdate")).alias("opened"))
    o = o.select("*", F.posexplode("steps").alias("pos", "step"))
    last = F.col("pos") == F.size("steps") - 1
    opened, who, vin = F.col("opened"), F.col("who"), F.col("vin")
    changed = F.timestamp_add("DAY", F.col("step.days"), opened)
    final = (F.when(state == "F", form(k, "4", "closed ", "Completed"))
             .when(state == "O", form(k, "1", "in progress", " Open", "2"))
             .otherwise(form(k, form(div(k, 3), "3", "Waiting Parts"), "cancelled", "paused")))
    km = (k * 104729) % 400_000 + 500
    odo = (F.when(k % 60 == 7, F.concat(F.lit("-"), km.cast("string")))
           .when(k % 60 == 8, (km + 3_000_000).cast("string"))
           .when(k % 60 == 9, F.lit("illegible"))
           .otherwise(form(k, km.cast("string"), F.concat(F.format_number(km, 0), F.lit(" km")),
                           F.concat(km.cast("string"), F.lit("KMS")))))
    hours = quarter_text((c + k) % 90 + F.when(k % 80 == 3, F.lit(98)).otherwise(F.lit(0)))
    code = form(k * 5, *seeds.service_codes(), UNKNOWN_SERVICE_CODE)
    return o.select(
        F.concat(form(k, "WO-", "wo", "W/O-", " WO "), padded(k, 6)).alias("wo_number"),
        F.when((c % 11 == 0) & (k % 4 == 1) & (k % 101 != 3), legacy_customer_id(c))
         .otherwise(form(k, customer_code(who), F.lower(customer_code(who)))).alias("customer_id"),
        F.when(k % 40 == 11, F.substring(vin, 1, 14)).when(k % 40 == 12, F.concat(vin, F.lit("7")))
         .when(k % 3 == 1, F.lower(F.concat(F.substring(vin, 1, 8), F.lit(" "), F.substring(vin, 9, 9))))
         .otherwise(vin).alias("vehicle_vin"),
        F.when(k % 333 == 5, F.lit("n.d."))
         .otherwise(time_text(opened, F.when(k % 5 == 2, 0).when(k % 5 == 4, 2).otherwise(1))).alias("date_opened"),
        F.when(last & (state == "F"), time_text(closed_ts(k, c, opened), div(k, 5)))
         .otherwise(F.lit("1900-01-01")).alias("date_closed"),
        F.when(last, final).otherwise(F.lit("OPEN")).alias("status"),
        form(k, code, F.concat(F.lit("\t"), code, F.lit(" ")), F.lower(code)).alias("service_type_code"),
        F.when(k % 9 == 4, form(div(k, 9), "", "n/a", "-", " unassigned"))
         .otherwise(F.concat(form(k, "tech-", "TECH-", " Tech-"), padded(div(c, 15) + 1, 4))).alias("technician_id"),
        F.concat(F.lit(" Bay-"), (k % 6 + 1).cast("string")).alias("bay_id"),
        odo.alias("odometer_reading"),
        form(k, hours, F.translate(hours, ".", ","), F.concat(hours, F.lit(" Hours"))).alias("labour_hours"),
        F.when(k % 6 == 0, F.lit(" \t "))
         .otherwise(F.concat(F.lit("  rattle   near\twheel "), (k % 4).cast("string"), F.lit(" "))).alias("customer_complaint"),
        form(k, "t", "NO", "yes", "0", "perhaps").alias("is_warranty"),
        F.col("step.op").alias("cdc_operation"),
        F.date_format(changed, "yyyy-MM-dd HH:mm:ss").alias("cdc_timestamp"),
        F.date_format(F.timestamp_add("HOUR", F.lit(1), changed), "yyyy-MM-dd HH:mm:ss").alias("_ingested_at"),
    )


# -------------------------------------------------------------------- lines
def line_kind() -> Column:
    flag = F.col("l_returnflag")
    return (F.when(flag == "N", F.lit("part")).when(flag == "A", F.lit("labour"))
            .otherwise(form(F.col("l_linenumber"), "return", "fee", "misc", "sublet", "part")))


def part_text(p: Column, idx: Column) -> Column:
    """Spellings of a part number, one of them a supplier's own (see ``part_number_aliases``)."""
    n = padded(p, 5)
    return form(idx, F.concat(F.lit("P-"), n), F.concat(F.lit("p"), n), F.concat(F.lit("P "), n, F.lit(" ")),
                F.concat(F.lit("p."), n), F.concat(F.lit("Alt-"), n))


def work_order_lines_raw(lineitem: DataFrame) -> DataFrame:
    """dms.work_order_lines with the source's own VAT rate and total; the rate
    goes by the ship date, and some part totals are wrong or missing."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                         "l_discount", "l_returnflag", "l_shipdate")
    k, n, p = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    li = li.withColumn("kind", line_kind())
    kind, q = F.col("kind"), F.col("l_quantity").cast("bigint")
    amount = F.when(kind == "labour", quarter_text(q)).otherwise(F.concat(q.cast("string"), F.lit(".00")))
    minus = F.when((kind == "return") | (k % 97 == 5), F.lit("-")).otherwise(F.lit(""))
    price = (F.when(kind == "labour", (F.lit(4000) + (p % 25) * 300).cast("decimal(14,2)"))
             .otherwise(F.col("l_extendedprice").cast("decimal(14,2)")))
    d = F.col("l_discount").cast("decimal(6,3)")
    rate = F.when(F.year(moved(F.col("l_shipdate"))) >= 2020, F.lit(Decimal("0.075"))).otherwise(F.lit(Decimal("0.050")))
    net = F.when(kind == "part", F.lit(1) - d).otherwise(F.lit(1)).cast("decimal(4,3)")
    sub = F.round(amount.cast("decimal(10,2)") * price * net, 2).cast("decimal(18,2)")
    total = F.round(sub * (F.lit(1) + rate), 2).cast("decimal(18,2)")
    total = F.when((kind == "part") & ((k * 17 + n) % 50 == 3), F.round(total * F.lit(Decimal("1.2")), 2).cast("decimal(18,2)")
                   ).otherwise(total)
    return li.select(
        F.concat(form(k + n, "WO-", "wo", "W/O-", " WO "), padded(k, 6)).alias("wo_number"),
        form(n, F.concat(F.lit(" "), n.cast("string")), n.cast("string")).alias("line_no"),
        form(p, F.upper(kind), F.concat(F.lit(" "), kind, F.lit(" ")), kind).alias("line_type"),
        F.when(kind.isin("part", "return"), part_text(p, F.col("l_suppkey"))).otherwise(F.lit("")).alias("part_number"),
        F.concat(F.lit("fit  item "), n.cast("string"), F.lit("\t ")).alias("description"),
        F.concat(minus, form(n, amount, F.translate(amount, ".", ","))).alias("quantity"),
        F.when(k % 193 == 2, F.concat(F.lit("-"), price.cast("string")))
         .when(k % 389 == 1, F.lit("call supplier")).otherwise(money_text(price, k + n)).alias("unit_price_ngn"),
        F.when((n % 2 == 0) & (d > F.lit(Decimal("0.010"))), (d * 100).cast("decimal(6,1)").cast("string"))
         .otherwise(d.cast("string")).alias("discount_pct"),
        F.when(n % 6 == 0, F.lit("")).otherwise(rate.cast("string")).alias("vat_rate"),
        F.when(k % 211 == 4, F.lit("")).otherwise(total.cast("string")).alias("line_total_ngn"),
    )


# -------------------------------------------------------------- technicians
def technician_code(s: Column) -> Column:
    return F.concat(F.lit("TECH-"), padded(s, 4))


def technicians_raw(supplier: DataFrame) -> DataFrame:
    """dms.technicians; the rate comes from the account balance."""
    s = F.col("s_suppkey")
    code = technician_code(s)
    hired = F.timestamp_add("DAY", ((s * 5) % 3000).cast("int"), F.lit("2009-03-01 07:30:00").cast("timestamp_ntz"))
    rate = (F.abs(F.col("s_acctbal")).cast("decimal(14,2)") + F.lit(1500)).cast("decimal(14,2)")
    return supplier.select(
        form(s, F.lower(code), code, F.concat(F.lit("\t"), code)).alias("technician_id"),
        F.concat(F.lit(" "), F.col("s_name")).alias("technician_name"),
        form(s, "SENIOR", " Junior", "master", "Apprentice ", "expert").alias("skill_level"),
        form(s, "Brakes; ac", "ENGINE", "transmission;Engine", "electrical;hybrid").alias("specialisation"),
        time_text(hired, s).alias("hire_date"),
        money_text(rate, s).alias("hourly_rate_ngn"),
        form(s, "no", "Yes", "f", "1").alias("is_active"),
    )


def technician_rate_history(supplier: DataFrame) -> DataFrame:
    """Date-effective hourly rates: four two-year periods per technician, with
    an early third one (overlap) or a late fourth one (gap) for some."""
    s = F.col("s_suppkey")
    base = F.abs(F.col("s_acctbal")).cast("decimal(14,2)") + F.lit(2000)
    h = supplier.select("s_suppkey", base.alias("_base"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("_i"))
    i = F.col("_i")
    start = F.make_date(F.lit(2015) + i * 2, F.lit(1), F.lit(1))
    vfrom = (F.when((i == 2) & (s % 13 == 0), F.date_sub(start, 30))
             .when((i == 3) & (s % 17 == 0), F.date_add(start, 60)).otherwise(start))
    vto = F.when(i == 3, F.lit("2099-12-31").cast("date")).otherwise(
        F.date_sub(F.make_date(F.lit(2017) + i * 2, F.lit(1), F.lit(1)), 1))
    return h.select(technician_code(s).alias("technician_id"), vfrom.alias("valid_from"), vto.alias("valid_to"),
                    (F.col("_base") + i * 250).cast("decimal(14,2)").alias("hourly_rate_ngn"))


# ---------------------------------------------------------- parts and stock
def on_hand(p: Column) -> Column:
    return (p * 13) % 183 - 2


def parts_raw(part: DataFrame) -> DataFrame:
    """erp.parts: prices in three currencies, a few unreadable stock figures."""
    p = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(14,2)")
    cost = F.round(price * F.lit(Decimal("0.65")), 2).cast("decimal(14,2)")
    return part.select(
        part_text(p, p % 4).alias("part_number"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit("  ")).alias("part_description"),
        F.concat(F.col("p_type"), F.lit(" ")).alias("category"),
        F.col("p_brand").alias("subcategory"),
        money_text(cost, p).alias("unit_cost_ngn"),
        money_text(price, p + 1).alias("unit_price_ngn"),
        F.concat(F.lit(" sup-"), (p % 25).cast("string")).alias("supplier_id"),
        F.when(p % 97 == 3, F.lit("many")).otherwise(on_hand(p).cast("string")).alias("qty_on_hand"),
        form(p, "N/A", "30", "", " 45").alias("reorder_point"),
        form(p, "USD", " eur", "ngn", "NGN ").alias("currency"),
    )


def part_number_aliases(part: DataFrame) -> DataFrame:
    """A supplier's own part number -> the canonical key."""
    n = padded(F.col("p_partkey"), 5)
    return part.select(F.concat(F.lit("ALT"), n).alias("alias"), F.concat(F.lit("P"), n).alias("part_number"))


STOCK_YEAR = "2021-01-01"


def stock_movements_raw(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """erp.stock_movements of one quarter: issues from part lines, returns from
    return lines, and one opening receipt per part, sized so that the ledger
    meets the on-hand figure (every ninth part is off by five)."""
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_returnflag")
    issue = F.col("l_returnflag") == "N"
    back = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") % 5 == 0)
    moves = li.where(issue | back)
    q, s, p = F.col("l_quantity").cast("bigint"), F.col("l_suppkey"), F.col("p_partkey")
    when = F.timestamp_add("HOUR", (F.col("l_orderkey") % 24).cast("int"),
                           F.date_add(F.lit(STOCK_YEAR).cast("date"), F.dayofyear("l_shipdate") % 90).cast("timestamp_ntz"))
    ledger = moves.select(
        F.concat_ws("-", F.lit("MV"), F.col("l_orderkey"), F.col("l_linenumber")).alias("movement_id"),
        part_text(F.col("l_partkey"), s % 4).alias("part_number"),
        F.when(issue, form(s, "issue", "Issue ", "ISSUE")).otherwise(form(s, "Return", "return ")).alias("movement_type"),
        F.when(issue & (s % 2 == 1), F.concat(F.lit("-"), q.cast("string"))).otherwise(q.cast("string")).alias("movement_qty"),
        F.date_format(when, "yyyy-MM-dd HH:mm:ss").alias("movement_date"),
        form(s, "central", " NORTH", "Central").alias("warehouse"),
        F.date_format(F.timestamp_add("HOUR", F.lit(2), when), "yyyy-MM-dd HH:mm:ss").alias("_ingested_at"))
    net = moves.groupBy("l_partkey").agg(F.sum(F.when(issue, q).otherwise(-q)).alias("net"))
    first = part.select("p_partkey").join(net, F.col("p_partkey") == F.col("l_partkey"), "left")
    opening = on_hand(p) + F.coalesce("net", F.lit(0)) + F.when(p % 9 == 0, F.lit(5)).otherwise(F.lit(0))
    receipts = first.select(
        F.concat_ws("-", F.lit("RC"), p).alias("movement_id"), part_text(p, p % 4).alias("part_number"),
        form(p, "grn", "Receipt", " RECEIPT").alias("movement_type"), opening.cast("string").alias("movement_qty"),
        F.lit("2020-12-31 18:00:00").alias("movement_date"), form(p, "central", " NORTH", "Central").alias("warehouse"),
        F.lit("2020-12-31 20:00:00").alias("_ingested_at"))
    return ledger.unionByName(receipts)


def price_list_raw(part: DataFrame, day: int) -> DataFrame:
    """supplier_feeds.price_list of a day (0, 1, ...): each day some parts are
    missing, others have a new price or another lead time; texts hold quotes and newlines."""
    p = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(14,2)") + F.when((p + day) % 10 < 3, F.lit(day * 25)).otherwise(F.lit(0))
    note = form(p, F.concat(F.lit('"'), F.col("p_brand"), F.lit('", genuine')), F.concat(F.lit("boxed\nset of "), (p % 4 + 2).cast("string")), "")
    return part.where((p + 3 * day) % 17 != 4).select(
        F.concat(F.lit("P"), padded(p, 5)).alias("part_number"), F.concat(F.lit("SUP-"), padded(p % 25, 4)).alias("supplier_id"),
        note.alias("description"), price.cast("decimal(14,2)").cast("string").alias("list_price"),
        F.concat((p % 9 + F.when((p + day) % 13 == 0, F.lit(day)).otherwise(F.lit(0))).cast("string"), F.lit(" days")).alias("lead_time"),
        form(p + div(p, 7) * day, "in stock", "on order").alias("availability"))


def fx_quotes(lineitem: DataFrame) -> DataFrame:
    """USD and EUR quotes in NGN on the first and fifteenth of months with shipments."""
    d = lineitem.select(F.to_date(moved(F.col("l_shipdate"))).alias("quote_date")).distinct()
    d = d.where(F.dayofmonth("quote_date").isin(1, 15))
    usd = F.lit(300) + (F.dayofyear("quote_date") * 7) % 150 + (F.year("quote_date") - 2015) * 40
    return d.select("quote_date", F.explode(F.array(
        F.struct(F.lit("USD").alias("currency"), usd.alias("rate")),
        F.struct(F.lit("EUR").alias("currency"), (usd + 55).alias("rate")))).alias("q")).select(
        "q.currency", "quote_date", F.col("q.rate").cast("decimal(10,4)").alias("rate_ngn"))


# ------------------------------------------------------ invoices, payments
def invoices_raw(orders: DataFrame) -> DataFrame:
    """pos.invoices: one for each finished order, in three currencies, with
    credit notes and missing totals."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    o = orders.where(F.col("o_orderstatus") == "F")
    day = F.timestamp_add("DAY", F.lit(1), opened_ts(k, F.col("o_orderdate")))
    total = F.col("o_totalprice").cast("decimal(14,2)")
    return o.select(
        F.concat(form(k, "INV-", "inv ", "Inv/"), padded(k, 6)).alias("invoice_number"),
        F.concat(form(c, "WO-", "wo"), padded(k, 6)).alias("wo_number"),
        time_text(day, k).alias("invoice_date"),
        form(k, "ngn", "", " USD", "NGN", "eur").alias("currency"),
        F.when(k % 90 == 6, F.lit("")).when(k % 90 == 5, F.concat(F.lit("-"), total.cast("string")))
         .otherwise(money_text(total, k)).alias("total"))


def payments_raw(orders: DataFrame) -> DataFrame:
    """pos.payments: two instalments, one, or none for a finished order."""
    k = F.col("o_orderkey")
    share = F.col("share")
    o = orders.where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_totalprice", F.posexplode(F.filter(F.array(
            F.when(k % 3 == 0, F.lit(Decimal("0.60"))), F.when(k % 3 == 0, F.lit(Decimal("0.40"))),
            F.when(k % 3 == 1, F.lit(Decimal("0.50")))), lambda x: x.isNotNull())).alias("pos", "share"))
    amount = F.round(F.col("o_totalprice").cast("decimal(14,2)") * share, 2).cast("decimal(14,2)")
    return o.select(
        F.concat_ws("-", F.lit("PAY"), k, F.col("pos")).alias("payment_id"),
        F.concat(form(k, "WO-", "w/o "), padded(k, 6)).alias("wo_number"),
        money_text(amount, k + F.col("pos")).alias("amount"),
        form(k + F.col("pos"), "Cash", "POS ", "bank transfer", "insurance", "cheque").alias("payment_method"))


# --------------------------------------------------- customers and vehicles
CITIES = ("lagos", "Kano", "LAG", "Lagos State", "port  harcourt", "ENUGU", " benin city")


def customers_raw(customer: DataFrame) -> DataFrame:
    """crm.customers: every eleventh still has its legacy id."""
    c, name = F.col("c_custkey"), F.col("c_name")
    mail = F.concat(F.lit("customer"), c.cast("string"), F.lit("@example.ng"))
    since = F.timestamp_add("DAY", ((c * 7) % 4000).cast("int"), F.lit("2010-01-01 09:00:00").cast("timestamp_ntz"))
    return customer.select(
        F.when(c % 11 == 0, legacy_customer_id(c)).otherwise(
            form(c, F.concat(F.lit(" "), customer_code(c)), F.lower(customer_code(c)))).alias("customer_id"),
        form(c, F.upper(name), F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("  # "))), F.lit(" ")), name).alias("customer_name"),
        form(c, "Individual", "FLEET ", " corporate", "INSURANCE", "walk-in").alias("customer_type"),
        phone_text(c).alias("phone_primary"),
        F.when(c % 20 == 4, F.lit("")).when(c % 20 == 5, F.lit("none")).when(c % 20 == 6, F.lit("no-at.example.ng"))
         .otherwise(form(c, mail, F.concat(F.lit(" "), F.upper(mail)))).alias("email"),
        form(F.col("c_nationkey"), *CITIES).alias("address_city"),
        time_text(since, c).alias("registration_date"))


def customer_id_migration(customer: DataFrame) -> DataFrame:
    """Legacy id -> current id."""
    c = F.col("c_custkey")
    return customer.where(c % 11 == 0).select(legacy_customer_id(c).alias("legacy_id"), customer_code(c).alias("customer_id"))


def vehicles_raw(customer: DataFrame) -> DataFrame:
    """crm.vehicles: one for each customer, with the VIN of the work orders."""
    c = F.col("c_custkey")
    customer = customer.select("c_custkey", vin_text(c).alias("vin"))
    vin = F.col("vin")
    plate = F.concat(form(c, "kan", "ABJ", "enu"), F.lit("-"), padded(c % 1000, 3), form(c, " xa", "KB"))
    return customer.select(
        form(c, vin, F.lower(vin), F.concat(F.substring(vin, 1, 11), F.lit("-"), F.substring(vin, 12, 6))).alias("vin"),
        F.when(c % 30 == 8, F.concat(F.lit("9"), plate)).otherwise(plate).alias("plate_number"),
        customer_code(c).alias("customer_id"),
        form(c, "Toyota Motors", "HONDA", "MERC", "lexus", "NISSAN", "Kia Motors", "FORD").alias("make"),
        form(c, "corolla", "COROLLA LE", " civic", "hilux  pickup").alias("model"),
        F.when(c % 12 == 5, F.lit("1949")).when(c % 12 == 6, F.lit("unknown"))
         .otherwise(F.concat(F.lit(" "), (F.lit(1995) + c % 27).cast("string"))).alias("year_manufactured"),
        form(c, "DIESEL", "petrol", "ev ", "Hybrid", "gas").alias("engine_type"),
        form(c, "Auto", "manual", "cvt ").alias("transmission"))


def vehicle_ownership_events(customer: DataFrame) -> DataFrame:
    """Every vehicle is registered to its customer; every seventh is later sold
    to the next one."""
    c = F.col("c_custkey")
    since = F.timestamp_add("DAY", ((c * 7) % 4000).cast("int"), F.lit("2010-01-01 09:00:00").cast("timestamp_ntz"))
    sold = F.timestamp_add("DAY", (c % 30).cast("int"), F.lit("2018-06-01 12:00:00").cast("timestamp_ntz"))
    first = customer.select(vin_text(c).alias("vin"), customer_code(c).alias("owner_id"), since.alias("changed_at"))
    again = customer.where(c % 7 == 0).select(
        vin_text(c).alias("vin"), customer_code(c + 1).alias("owner_id"), sold.alias("changed_at"))
    return first.unionByName(again)


def person_name(key: Column) -> Column:
    """A two-word pseudo name derived from the key's MD5 (letters only)."""
    letters = F.translate(F.md5(key.cast("string")), "0123456789", "ghijklmnop")
    return F.initcap(F.concat(F.substring(letters, 1, 5), F.lit(" "), F.substring(letters, 6, 6)))


def contacts(df: DataFrame, key: str, nation: str, prefix: str, dup_prefix: str) -> DataFrame:
    """Contact records: every entity, re-entered copies (same phone, or one
    letter changed) and near copies (three letters changed), and short names
    that lie within a few letters of each other."""
    c = F.col(key)
    name, city = person_name(c), form(F.col(nation), *CITIES)
    mail = F.when(c % 20 < 3, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(prefix.lower().rstrip("-")), c.cast("string"), F.lit("@example.ng")))
    none = F.lit(None).cast("string")
    base = df.select(F.concat(F.lit(prefix), padded(c, 6)).alias("contact_id"), name.alias("contact_name"),
                     phone_text(c).alias("phone_primary"), mail.alias("email"), city.alias("address_city"))
    near = F.overlay(F.overlay(F.overlay(name, F.lit("q"), 2, 1), F.lit("q"), 5, 1), F.lit("q"), 9, 1)
    style = div(c, 12) % 3
    again = df.where((c % 12 == 5) | (c % 12 == 7)).select(
        F.concat(F.lit(dup_prefix), padded(c, 6)).alias("contact_id"),
        F.when(c % 12 == 7, near).when(style == 0, F.upper(name))
         .when(style == 1, F.concat(F.replace(name, F.lit(" "), F.lit("   ")), F.lit(" ")))
         .otherwise(F.overlay(name, F.lit("z"), 3, 1)).alias("contact_name"),
        F.when((c % 12 == 5) & (style < 2), phone_text(c)).otherwise(F.lit("0602 000 0000")).alias("phone_primary"),
        none.alias("email"), city.alias("address_city"))
    short = df.where(c % 40 == 9).select(
        F.concat(F.lit(dup_prefix), F.lit("S"), padded(c, 6)).alias("contact_id"),
        F.substring(F.upper(F.replace(name, F.lit(" "), F.lit(""))), 1, 1 << 30).substr(F.lit(1), (div(c, 40) % 4 + 1).cast("int"))
         .alias("contact_name"),
        F.lit("0602 000 0000").alias("phone_primary"), none.alias("email"), city.alias("address_city"))
    return base.unionByName(again).unionByName(short)


def customer_contacts(customer: DataFrame) -> DataFrame:
    """crm.customers for entity resolution."""
    return contacts(customer, "c_custkey", "c_nationkey", "CUST-", "DUP-") \
        .withColumnRenamed("contact_id", "customer_id").withColumnRenamed("contact_name", "customer_name")


def supplier_contacts(supplier: DataFrame) -> DataFrame:
    """erp.suppliers for supplier de-duplication."""
    return contacts(supplier, "s_suppkey", "s_nationkey", "SUP-", "SUPDUP-") \
        .withColumnRenamed("contact_id", "supplier_id").withColumnRenamed("contact_name", "supplier_name")


# --------------------------------------------------------------- telematics
def arrival_time(event_id: Column, ts: Column) -> Column:
    """Every seventh event arrives up to 99 hours late, the others within minutes."""
    return (F.when(event_id % 7 == 0, F.timestamp_add("HOUR", ((event_id * 37) % 100).cast("int"), ts))
            .otherwise(F.timestamp_add("MINUTE", (event_id % 5).cast("int"), ts)))


def telematics_raw(events: DataFrame) -> DataFrame:
    """telematics.events as delivered: text fields, epoch milliseconds, the fault
    code by the JSON payload; a few unreadable times and odometers."""
    e, u, vin = F.col("event_id"), F.col("user_id"), F.col("vin")
    events = events.select("event_id", "user_id", "ts", "value", "props", vin_text(u).alias("vin"))
    place = F.coalesce(F.from_json("props", "k int")["k"], F.lit(0))
    degrees = lambda n, base, span: F.concat((F.lit(base) + div(n % span, 100)).cast("string"), F.lit("."), padded(n % 100, 2))
    return events.select(
        F.concat(F.lit(" EV-"), padded(e, 8)).alias("event_id"),
        F.when(u % 17 == 0, F.substring(vin, 1, 16)).when(u % 3 == 0, F.lower(vin)).otherwise(vin).alias("vin"),
        F.when(e % 401 == 11, F.lit("soon")).otherwise(
            F.lpad(F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), 13, "0")).alias("event_timestamp"),
        F.when(e % 307 == 8, F.lit("n/a")).otherwise(
            F.concat(F.round(F.col("value") * 1000).cast("bigint").cast("string"), F.lit(" km"))).alias("odometer_km"),
        form(place, "p0300", " P0171", "P0420 ", "P0442", "P0999", "", "p0128").alias("fault_code"),
        degrees(e, 4, 1100).alias("latitude"), degrees(e * 7, 3, 1300).alias("longitude"),
        F.date_format(arrival_time(e, F.col("ts")), "yyyy-MM-dd HH:mm:ss").alias("_ingested_at"))
