"""A small literal demo: three sites, three halls each, five films, 17 published shows.

Four pairs of a busy and a quiet show start within the band; three of them are
worth swapping, the fourth would move a PREMIUM film to a STANDARD hall. Every
number is a literal here, so that the tests can be followed by hand:

  halls of every site: h1 60 seats STANDARD, h2 150 STANDARD, h3 240 PREMIUM
  films: amber STANDARD 9.00, baseline 180; basalt STANDARD 12.50, 140; cedar PREMIUM 18.00, 200;
         dune STANDARD 7.50, 40; ember STANDARD 10.00, 55
  every show lasts two hours; bookings are of 12:00 on the run date
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from slotwise.schemas import FEEDS as SCHEMAS

RUN = date(2026, 7, 1)
NOON = datetime(2026, 7, 1, 12)
LOADED = datetime(2026, 7, 1, 6, 30)
SITES = ("harbor", "north", "south")
HALLS = {"h1": (60, "STANDARD"), "h2": (150, "STANDARD"), "h3": (240, "PREMIUM")}
FILMS = {"amber": ("STANDARD", 9.0, 180.0), "basalt": ("STANDARD", 12.5, 140.0), "cedar": ("PREMIUM", 18.0, 200.0),
         "dune": ("STANDARD", 7.5, 40.0), "ember": ("STANDARD", 10.0, 55.0)}
# show id: site, hall, film, start, seats booked
SHOWS = {
    "n-busy": ("north", "h2", "amber", datetime(2026, 7, 2, 20, 30), 70),
    "n-quiet": ("north", "h3", "dune", datetime(2026, 7, 2, 20, 40), 12),
    "s-busy": ("south", "h1", "basalt", datetime(2026, 7, 1, 21, 0), 45),
    "s-quiet": ("south", "h2", "ember", datetime(2026, 7, 1, 20, 50), 20),
    "h-busy": ("harbor", "h2", "basalt", datetime(2026, 7, 5, 18, 15), 60),
    "h-quiet": ("harbor", "h3", "dune", datetime(2026, 7, 5, 18, 15), 10),
    "x-busy": ("north", "h1", "amber", datetime(2026, 7, 3, 21, 0), 30),
    "x-quiet": ("north", "h3", "cedar", datetime(2026, 7, 3, 21, 10), 40),
} | {f"{site[0]}-noon{d}": (site, "h1", "ember", datetime(2026, 7, 2 + d, 11, 0), 8 * d) for site in SITES for d in range(3)}


def show_row(show: str, site: str, hall: str, film: str, start: datetime, status: str = "PUBLISHED", locked: bool | None = False,
             loaded: datetime = LOADED, minutes: int = 120) -> tuple:
    return (show, site, f"{site}/{hall}", film, start, start + timedelta(minutes=minutes), status, locked, loaded, loaded)


def booking_row(show: str, start: datetime, seats: int, taken: datetime = NOON, loaded: datetime = LOADED, tag: str = "") -> tuple:
    return (f"{show}@{taken:%d%H}{tag}", show, taken, seats, seats // 3 + 1, 8.0 * seats, (start - taken).total_seconds() / 3600, loaded)


def demo_rows() -> dict[str, list[tuple]]:
    """Rows of every feed, by feed name."""
    halls = [(site, hall, *what) for site in SITES for hall, what in HALLS.items()]
    return {
        "theatre_master": [(s, s.title(), "Town", "Shire", "West", "UTC", "ACTIVE", LOADED) for s in SITES],
        "screen_master": [(f"{s}/{h}", s, f"Hall {h}", seats, kind, True, LOADED) for s, h, seats, kind in halls],
        "movie_master": [(f, f.title(), "Drama", "English", 100, kind, RUN, "Own", price, base, LOADED) for f, (kind, price, base) in FILMS.items()],
        "showtime_schedule": [show_row(show, *what[:4]) for show, what in SHOWS.items()],
        "booking_snapshot": [booking_row(show, what[3], what[4]) for show, what in SHOWS.items()],
        "screen_availability": [(f"{s}/{h}/all", s, f"{s}/{h}", LOADED, LOADED + timedelta(days=9), True, None, 15, LOADED) for s, h, _, _ in halls],
        "schedule_policy": [(f"rules-{s}", s, 6.0, 200.0, 0.7, 4, LOADED) for s in SITES],
    }


def demo_feeds(spark, rows: dict[str, list[tuple]] | None = None):
    rows = rows or demo_rows()
    return {name: spark.createDataFrame(rows[name], feed.schema()) for name, feed in SCHEMAS.items()}
