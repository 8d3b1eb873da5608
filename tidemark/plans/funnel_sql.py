"""SQL text shared by the checks: the derived funnel tables as common table expressions."""

CONTACTS = """
contact_rows AS (
  SELECT *, o_orderdate + to_hours(l_orderkey % 24) AS inter
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), contact_checkins AS (
  SELECT *, CASE WHEN l_linenumber < 7 THEN inter + to_days(l_linenumber - 2) END AS checkin
  FROM contact_rows
), contacts AS (
  SELECT 'C' || o_custkey AS id_guest_anon, 'S' || l_suppkey AS id_host_anon,
    CAST(l_partkey AS VARCHAR) AS id_listing_anon,
    inter AS ts_interaction_first,
    CASE WHEN l_returnflag <> 'R' THEN inter + to_minutes(CAST(10 * l_quantity AS BIGINT)) END AS ts_reply_at_first,
    CASE WHEN l_returnflag = 'A' THEN inter + to_minutes(CAST(30 * l_quantity AS BIGINT)) END AS ts_accepted_at_first,
    CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F'
      THEN inter + to_hours(CAST(l_quantity AS BIGINT)) END AS ts_booking_at,
    checkin AS ds_checkin_first,
    checkin + to_days(CAST(1 + l_partkey % 14 AS INTEGER)) AS ds_checkout_first,
    CAST(l_linenumber AS DOUBLE) AS m_guests,
    l_quantity AS m_interactions,
    CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS DOUBLE) AS m_first_message_length_in_characters,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'instant_book' WHEN '2-HIGH' THEN 'book_it'
      WHEN '5-LOW' THEN NULL ELSE 'contact_me' END AS contact_channel_first,
    CASE o_orderstatus WHEN 'F' THEN 'past_booker' WHEN 'O' THEN 'new' END AS guest_user_stage_first
  FROM contact_checkins
)"""

LISTINGS = """
listings AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id_listing_anon,
    CASE WHEN p_type IN ('STANDARD', 'LARGE') THEN 'Entire home/apt'
      WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'Shared room' ELSE 'Private room' END AS room_type,
    p_brand AS listing_neighborhood, CAST(p_size AS DOUBLE) AS total_reviews
  FROM part
)"""

USERS = """
users AS (
  SELECT id AS id_user_anon, n_name AS country, CAST(floor(abs(bal) / 100) AS DOUBLE) AS words_in_user_profile
  FROM (SELECT 'C' || c_custkey AS id, c_nationkey AS nk, c_acctbal AS bal FROM customer
        UNION ALL SELECT 'S' || s_suppkey, s_nationkey, s_acctbal FROM supplier)
  JOIN nation ON nk = n_nationkey
)"""

MASTER = f"""{CONTACTS}, {LISTINGS}, {USERS},
master AS (
  SELECT c.*, l.room_type, l.listing_neighborhood, l.total_reviews,
    g.country AS guest_country, g.words_in_user_profile AS words_in_guest_profile,
    h.country AS host_country, h.words_in_user_profile AS words_in_host_profile
  FROM contacts c
  JOIN listings l ON c.id_listing_anon = l.id_listing_anon
  JOIN users g ON c.id_guest_anon = g.id_user_anon
  JOIN users h ON c.id_host_anon = h.id_user_anon
  WHERE (ds_checkin_first IS NULL OR ds_checkin_first >= ts_interaction_first)
    AND (ts_reply_at_first IS NULL
      OR date_diff('microsecond', ts_interaction_first, ts_reply_at_first) < 17280000000)
)"""

INQUIRIES = """
inquiries AS (
  SELECT date_trunc('hour', ts_interaction_first) AS inquiry_time,
    count(ts_interaction_first) AS total_inquiries,
    avg(m_guests) AS avg_guests,
    avg(m_interactions) AS avg_interactions,
    CAST(count(ts_interaction_first) AS DOUBLE) / nullif(count(DISTINCT id_guest_anon), 0) AS avg_inquires_per_guest,
    CAST(count(*) FILTER (room_type = 'Entire home/apt') AS BIGINT) AS total_home_inquires,
    CAST(count(*) FILTER (room_type = 'Shared room') AS BIGINT) AS total_shared_inquires,
    CAST(count(*) FILTER (room_type = 'Private room') AS BIGINT) AS total_private_inquires,
    avg(m_first_message_length_in_characters) AS avg_message_length,
    CAST(count(*) FILTER (contact_channel_first = 'contact_me') AS BIGINT) AS total_contact_me,
    CAST(count(*) FILTER (contact_channel_first = 'book_it') AS BIGINT) AS total_book_it,
    CAST(count(*) FILTER (contact_channel_first = 'instant_book') AS BIGINT) AS total_instant_book,
    CAST(count(*) FILTER (contact_channel_first = 'contact_me') AS DOUBLE)
      / nullif(count(contact_channel_first), 0) AS pct_contact_me,
    CAST(count(*) FILTER (contact_channel_first = 'book_it') AS DOUBLE)
      / nullif(count(contact_channel_first), 0) AS pct_book_it_me,
    CAST(count(*) FILTER (contact_channel_first = 'instant_book') AS DOUBLE)
      / nullif(count(contact_channel_first), 0) AS pct_instant_book,
    CAST(count(*) FILTER (guest_user_stage_first = 'past_booker') AS DOUBLE)
      / nullif(count(guest_user_stage_first), 0) AS pct_past_booker,
    CAST(count(*) FILTER (guest_user_stage_first = 'new') AS DOUBLE)
      / nullif(count(guest_user_stage_first), 0) AS pct_new_user
  FROM master GROUP BY 1
)"""

REPLIES = """
replies AS (
  SELECT date_trunc('hour', ts_reply_at_first) AS reply_time, count(ts_reply_at_first) AS total_replies,
    avg(CAST(date_diff('microsecond', ts_interaction_first, ts_reply_at_first) AS DOUBLE) / 3.6e9) AS avg_reply_hours
  FROM master GROUP BY 1
)"""

ACCEPTED = """
accepted AS (
  SELECT date_trunc('hour', ts_accepted_at_first) AS accepted_time, count(ts_accepted_at_first) AS total_accepted
  FROM master GROUP BY 1
)"""

BOOKINGS = """
bookings AS (
  SELECT date_trunc('hour', ts_booking_at) AS booking_time, count(ts_booking_at) AS total_booking
  FROM master GROUP BY 1
)"""

STAGES = f"{MASTER}, {INQUIRIES}, {REPLIES}, {ACCEPTED}, {BOOKINGS}"
