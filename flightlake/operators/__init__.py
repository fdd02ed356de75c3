from .dedupe import dedupe, distinct_keys
from .gold import (airport_hourly_delay, airport_hourly_delay_from, carrier_performance, carrier_performance_from,
                   carrier_stats, delay_cause_breakdown, delay_cause_breakdown_from,
                   live_route_summary, monthly_hour_partials, monthly_route_partials,
                   route_delay_summary, route_delay_summary_from, route_partials, routes_from)
from .topk import first_n_per_group
from .join import (bounded_broadcast, fanout_summary, flight_weather, latest_weather,
                   station_of)
from .silver import (NEWEST_FIRST, POLL_STATUSES, WEATHER_PARTITION, clean_ontime,
                     flatten_live, flatten_weather, live_silver, ontime_silver,
                     polled_flights, station_registry, weather_silver, with_obs_date)

__all__ = [
    "dedupe", "distinct_keys",
    "airport_hourly_delay", "carrier_performance", "carrier_stats", "delay_cause_breakdown",
    "live_route_summary", "route_delay_summary", "route_partials",
    "airport_hourly_delay_from", "monthly_hour_partials", "monthly_route_partials", "routes_from",
    "route_delay_summary_from", "carrier_performance_from", "delay_cause_breakdown_from",
    "bounded_broadcast", "fanout_summary", "flight_weather", "latest_weather", "station_of",
    "clean_ontime", "flatten_live", "flatten_weather", "live_silver", "ontime_silver",
    "station_registry", "weather_silver", "with_obs_date", "WEATHER_PARTITION",
    "polled_flights", "NEWEST_FIRST", "POLL_STATUSES", "first_n_per_group",
]
