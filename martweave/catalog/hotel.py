"""Registered hotel queries."""

from __future__ import annotations

from .. import fixed_values as V
from ..plans import hotel as H
from . import standins as S
from .common import Catalog, big, day, dbl, groups_sql, plain, quoted, rounded, steps_sql

catalog = Catalog()

_INTS = [
    "is_canceled",
    "lead_time",
    "arrival_date_year",
    "arrival_date_week_number",
    "arrival_date_day_of_month",
    "stays_in_weekend_nights",
    "stays_in_week_nights",
    "adults",
    "children",
    "babies",
    "is_repeated_guest",
    "previous_cancellations",
    "previous_bookings_not_canceled",
    "booking_changes",
    "agent",
    "company",
    "days_in_waiting_list",
    "required_car_parking_spaces",
    "total_of_special_requests",
]


def staged(spark, folder):
    return H.stage_bookings(S.BOOKINGS.frame(spark, folder))


def transformed(spark, folder):
    return H.transformed_bookings(staged(spark, folder))


def details(spark, folder):
    return H.cancellation_details(transformed(spark, folder))


@catalog.add(
    "staged_bookings",
    "select "
    + ", ".join(
        f"{big(c)} {c}" if c in _INTS else f"{dbl(c)} {c}" if c == "adr" else f"{day(c)} {c}" if c.endswith("_date") else c
        for c in H.BOOKING_COLUMNS
    )
    + f" from {S.BOOKINGS.sql}",
)
def _(spark, folder):
    return plain(staged(spark, folder))


_TEXT = "case when {} then 'TRUE' else 'FALSE' end"
_BASE_SQL = f"""(select *, {_TEXT.format('is_canceled = 1')} canceled_text,
  strptime(concat_ws(' ', arrival_date_year, arrival_date_month, arrival_date_day_of_month), '%Y %B %d')::date arrival,
  stays_in_weekend_nights + stays_in_week_nights nights,
  adr * (stays_in_weekend_nights + stays_in_week_nights) revenue
  from {S.BOOKINGS.sql}
  where hotel in ({quoted(V.HOTEL_KINDS)}) and adr > 0 and stays_in_weekend_nights + stays_in_week_nights > 0)"""


@catalog.add(
    "bookings_transformed",
    f"""select hotel_id, hotel, canceled_text is_canceled, {big('lead_time')} leadtime_days, {day('arrival')} arrival_date,
    {big('arrival_date_week_number')} arrival_date_week_number, {big('stays_in_weekend_nights')} stays_in_weekend_nights,
    {big('stays_in_week_nights')} stays_in_week_nights, {big('nights')} total_stay_nights, {big('adults')} adults,
    {big('children')} children, {big('babies')} babies,
    {_TEXT.format('coalesce(children, 0) > 0 or coalesce(babies, 0) > 0')} is_family_booking, meal meal_package,
    market_segment, distribution_channel, {_TEXT.format('is_repeated_guest = 1')} is_repeated_guest,
    {big('previous_cancellations')} previous_cancellations,
    {big('previous_bookings_not_canceled')} previous_bookings_not_canceled, reserved_room_type, assigned_room_type,
    {big('booking_changes')} booking_changes, deposit_type, agent, company, {big('days_in_waiting_list')} days_in_waiting_list,
    customer_type, {dbl('adr')} average_daily_rate, {big('required_car_parking_spaces')} required_car_parking_spaces,
    {big('total_of_special_requests')} total_of_special_requests, reservation_status,
    {day('reservation_status_date')} reservation_status_update_date, {dbl('revenue')} estimated_revenue
    from {_BASE_SQL}""",
)
def _(spark, folder):
    return plain(transformed(spark, folder))


_DETAIL_SQL = f"""(select b.*, canceled_text = 'TRUE' gone, arrival - lead_time booked,
  date_diff('day', reservation_status_date, arrival) days_left,
  case canceled_text when 'TRUE' then 'Canceled' else 'Retained' end || ' - ' || coalesce(deposit_type, '{V.NO_DEPOSIT}') outcome
  from {_BASE_SQL} b)"""


@catalog.add(
    "cancellations_deep_dive",
    f"""select hotel_id, hotel, canceled_text is_canceled, {big('lead_time')} leadtime_days, {day('arrival')} arrival_date,
    reservation_status, {day('reservation_status_date')} reservation_status_update_date, deposit_type,
    {dbl('adr')} average_daily_rate, {big('nights')} total_stay_nights, {dbl('revenue')} estimated_revenue, market_segment,
    distribution_channel, customer_type, reserved_room_type, assigned_room_type,
    {big('previous_cancellations')} previous_cancellations, {day('booked')} booking_date,
    if(gone, date_diff('day', booked, reservation_status_date), null) days_to_cancellation,
    if(gone, days_left, null) days_before_arrival_at_cancellation,
    gone and days_left is not null and days_left < {V.LATE_CANCELLATION_DAYS} is_late_cancellation,
    outcome deposit_cancellation_outcome, if(gone, {dbl('revenue')}, 0) revenue_lost from {_DETAIL_SQL}""",
)
def _(spark, folder):
    return plain(details(spark, folder))


_DIMS = ", ".join(H.DIMENSIONS)


def _bands_sql(where: str) -> str:
    return ", ".join(
        f"count(*) filter ({where} and lead_time between {low if low is not None else -1000000} and {high if high is not None else 1000000}) {name}"
        for name, low, high in V.LEAD_BANDS
    )


def _match(left: str, right: str) -> str:
    return " and ".join(f"{left}.{d} = {right}.{d}" for d in H.DIMENSIONS)


_LATE = f"gone and days_left < {V.LATE_CANCELLATION_DAYS}"


@catalog.add(
    "cancellation_analysis",
    f"""with d as (select * from {_DETAIL_SQL}),
    kpi as (select {_DIMS}, count(*) n, count(*) filter (gone) c, coalesce(sum(revenue) filter (gone), 0) lost,
      avg(adr) filter (gone) rate_c, avg(adr) filter (not gone) rate_r, count(*) filter ({_LATE}) late,
      coalesce(sum(revenue) filter ({_LATE}), 0) late_lost from d group by {_DIMS}),
    lead_time as (select {_DIMS}, avg(lead_time) mean, min(lead_time) low, max(lead_time) high, {_bands_sql('true')}
      from d where gone group by {_DIMS}),
    dep as (select {_DIMS}, outcome, 100.0 * count(*) filter (gone) / count(*) rate from d group by {_DIMS}, outcome)
    select {', '.join('kpi.' + x for x in H.DIMENSIONS)}, n total_bookings, c total_cancellations,
    {rounded('100.0 * c / n', 2)} cancellation_rate_pct, {dbl('lost')} total_revenue_lost,
    {rounded('rate_c', 2)} avg_adr_canceled, {rounded('rate_r', 2)} avg_adr_retained, late late_cancellation_count,
    {dbl('late_lost')} late_cancellation_revenue_lost, {rounded('mean', 1)} avg_leadtime_canceled,
    {big('low')} min_leadtime_canceled, {big('high')} max_leadtime_canceled,
    {', '.join(name for name, _, _ in V.LEAD_BANDS)},
    outcome deposit_cancellation_outcome, {rounded('rate', 2)} deposit_type_cancellation_rate_pct
    from kpi left join lead_time l on {_match('kpi', 'l')} left join dep on {_match('kpi', 'dep')}""",
)
def _(spark, folder):
    return plain(H.cancellation_analysis(details(spark, folder)))


@catalog.add(
    "lead_time_profile",
    f"""select {_DIMS}, canceled_text is_canceled, {rounded('avg(lead_time)', 1)} avg_leadtime_days,
    {big('min(lead_time)')} min_leadtime_days, {big('max(lead_time)')} max_leadtime_days, {_bands_sql('true')}
    from {_DETAIL_SQL} group by {_DIMS}, canceled_text""",
)
def _(spark, folder):
    return plain(H.lead_time_profile(details(spark, folder)))


@catalog.add(
    "deposit_effectiveness",
    f"""select {_DIMS}, outcome deposit_cancellation_outcome, count(*) booking_count,
    {dbl('sum(if(gone, revenue, 0))')} revenue_lost,
    {rounded('100.0 * count(*) filter (gone) / count(*)', 2)} cancellation_rate_pct
    from {_DETAIL_SQL} group by {_DIMS}, outcome""",
)
def _(spark, folder):
    return plain(H.deposit_effectiveness(details(spark, folder)))


@catalog.add(
    "daily_hotel_revenue",
    f"""select {day('arrival')} arrival_date, r.hotel_id, hotel_name, {dbl('total')} total_revenue
    from (select hotel_id, hotel, arrival, sum(revenue) total from {_BASE_SQL} group by all) r
    join (select distinct hotel_id, hotel_name from {S.BOOKINGS.sql}) n on n.hotel_id = r.hotel_id""",
)
def _(spark, folder):
    return plain(H.daily_revenue(transformed(spark, folder), staged(spark, folder)))


_SEGMENT_SQL = f"""(select *, case when score >= 2500 and segment = 'Loyal' then
    {steps_sql('score', V.LOYAL_TIERS, None)} else {steps_sql('score', V.OPEN_TIERS, f"'{V.TIER_DEFAULT}'")} end tier
  from (select lead_time, nights, previous_cancellations, reserved_room_type, adr, revenue,
    row_number() over (order by lead_time, nights, repeat_text, previous_cancellations, reserved_room_type, adr, reservation_status, revenue) id,
    case when lead_time < 30 and nights < 3 and repeat_text = 'FALSE' then 'New'
      when lead_time >= 30 and nights >= 3 and repeat_text = 'TRUE' then 'Loyal' else 'Occasional' end segment,
    {steps_sql('nights', V.STAY_POINTS, 0)} + if(repeat_text = 'TRUE', {V.REPEAT_GUEST_POINTS}, 0)
      + if(previous_cancellations > 0, {V.CANCELLATION_PENALTY}, 0)
      + {groups_sql('reserved_room_type', V.ROOM_POINTS, 0)} + {steps_sql('adr', V.RATE_POINTS, 0)}
      + {groups_sql('reservation_status', V.RESERVATION_POINTS, 0)} + {steps_sql('revenue', V.REVENUE_POINTS, 0)} score
    from (select *, {_TEXT.format('is_repeated_guest = 1')} repeat_text from {_BASE_SQL})))"""


@catalog.add(
    "customer_segments",
    f"""select id customer_id, segment customer_segment, {big('lead_time')} leadtime_days, {big('nights')} total_stay_nights,
    {big('previous_cancellations')} previous_cancellations, reserved_room_type, {dbl('adr')} average_daily_rate,
    {dbl('revenue')} estimated_revenue, {big('score')} total_loyalty_score, tier loyalty_tier from {_SEGMENT_SQL}""",
)
def _(spark, folder):
    return plain(H.customer_segments(transformed(spark, folder), numbering="content"))


@catalog.add(
    "customer_segmentation",
    f"""select segment customer_segment, tier loyalty_tier, count(*) customer_count,
    {rounded('avg(lead_time)', 1)} avg_leadtime_days, {rounded('avg(nights)', 1)} avg_stay_nights,
    {big('sum(nights)')} total_stay_nights,
    {rounded('100.0 * count(*) filter (previous_cancellations > 0) / count(*)', 2)} cancellation_rate_pct,
    {rounded('avg(adr)', 2)} avg_daily_rate, {dbl('sum(adr)')} total_revenue_proxy, {rounded('avg(score)', 1)} avg_loyalty_score,
    {big('min(score)')} min_loyalty_score, {big('max(score)')} max_loyalty_score,
    {rounded('100.0 * count(*) / sum(count(*)) over (partition by tier)', 2)} pct_of_tier,
    {rounded('100.0 * count(*) / sum(count(*)) over (partition by segment)', 2)} pct_of_segment
    from {_SEGMENT_SQL} group by segment, tier""",
)
def _(spark, folder):
    return plain(H.customer_segmentation(H.customer_segments(transformed(spark, folder))))
