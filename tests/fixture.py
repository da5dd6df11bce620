"""Small CSV files shaped like the seven energy tables, and a plain-Python training table."""

from __future__ import annotations

import csv
import datetime
import json
import math
import os
import random

START = datetime.datetime(2023, 1, 1)
DAYS = 16
SEGMENTS = [(0, 0, 1, 0), (0, 0, 1, 1), (0, 1, 3, 1), (1, 0, 2, 0), (1, 1, 9, 1)]
STATIONS = [(57.6, 21.7, "0", "Harju"), (57.9, 21.7, "0", "Harju"), (58.2, 22.2, "1", "Hiiu"), (58.2, 22.7, "", "")]
FORECAST = (
    "hours_ahead temperature dewpoint cloudcover_high cloudcover_low cloudcover_mid cloudcover_total "
    "10_metre_u_wind_component 10_metre_v_wind_component direct_solar_radiation "
    "surface_solar_radiation_downwards snowfall total_precipitation"
).split()
MEASURED = (
    "temperature dewpoint rain snowfall surface_pressure cloudcover_total cloudcover_low cloudcover_mid "
    "cloudcover_high windspeed_10m winddirection_10m shortwave_radiation direct_solar_radiation diffuse_radiation"
).split()


def _write(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)
    return path


def write(base, days: int = DAYS, seed: int = 1) -> dict[str, str]:
    rng = random.Random(seed)
    hours = [START + datetime.timedelta(hours=h) for h in range(0, days * 24, 6)]
    block = lambda t: (t.date() - START.date()).days
    day = lambda n: START.date() + datetime.timedelta(days=n)
    train, clients, gas, electricity, forecast, measured = [], [], [], [], [], []
    n = 0
    for c, b, p, k in SEGMENTS:
        for t in hours:
            if rng.random() < 0.03:
                continue  # gaps
            target = "" if rng.random() < 0.02 else round(rng.uniform(0, 100), 3)
            train.append([c, b, p, target, k, str(t), block(t), n, n % 7])
            n += 1
    for c, b, p in sorted({s[:3] for s in SEGMENTS}):
        for i in range(days):
            clients.append([p, c, rng.randrange(5, 300), round(rng.uniform(10, 900), 2), b, day(i), i + 2])
    for i in range(days):
        low = round(rng.uniform(30, 50), 2)
        gas.append([day(i), low, low + 1.25, day(i), i + 1])
    for t in hours:
        electricity.append([str(t), round(rng.uniform(-10, 90), 2), str(t), block(t) + 1])
        for lat, lon, _, _ in STATIONS + [(59.9, 30.0, "", "")]:
            values = [round(rng.uniform(-5, 50), 2) for _ in MEASURED]
            known = t + datetime.timedelta(days=1 if t.hour < 11 else 2)
            measured.append([lat, lon, str(t), *values, block(known)])
            ahead = [24 + t.hour] + [round(rng.uniform(-5, 50), 2) for _ in FORECAST[1:]]
            forecast.append([lat, lon, str(t), str(t), *ahead, block(t)])
    at = lambda *parts: os.path.join(str(base), *parts)
    with open(at("counties.json"), "w") as f:
        json.dump({"0": "Harju", "1": "Hiiu"}, f)
    return {
        "train": _write(
            at("train", "train.csv"),
            "county is_business product_type target is_consumption datetime data_block_id row_id prediction_unit_id".split(),
            train,
        ),
        "clients": _write(
            at("clients", "client.csv"),
            "product_type county eic_count installed_capacity is_business date data_block_id".split(),
            clients,
        ),
        "gas": _write(
            at("gas", "gas.csv"),
            "forecast_date lowest_price_per_mwh highest_price_per_mwh origin_date data_block_id".split(),
            gas,
        ),
        "electricity": _write(
            at("electricity", "e.csv"), "forecast_date euros_per_mwh origin_date data_block_id".split(), electricity
        ),
        "weather_station_map": _write(
            at("stations.csv"),
            "longitude latitude county county_name".split(),
            [(lon, lat, c, name) for lat, lon, c, name in STATIONS],
        ),
        "weather_forecast": _write(
            at("forecast", "f.csv"),
            ["latitude", "longitude", "origin_datetime", "forecast_datetime", *FORECAST, "data_block_id"],
            forecast,
        ),
        "historical_weather": _write(
            at("measured", "m.csv"), ["latitude", "longitude", "datetime", *MEASURED, "data_block_id"], measured
        ),
        "counties": at("counties.json"),
    }


def _read(path):
    with open(path) as f:
        return list(csv.DictReader(f))


def _mean(values):
    return sum(values) / len(values) if values else None


def expected_rows(paths) -> dict[tuple, dict]:
    """Training rows by (segment, time), from nested loops over the CSV files (no interval)."""
    when = datetime.datetime.fromisoformat
    day = datetime.timedelta(days=1)
    county = {(lat, lon): int(c) if c else -1 for lat, lon, c, _ in STATIONS}

    def weather(path, measures, time_column):
        groups = {}
        for r in _read(path):
            place = county.get((float(r["latitude"]), float(r["longitude"])))
            groups.setdefault((place, when(r[time_column]), int(r["data_block_id"])), []).append(r)
        return {k: {m: _mean([float(r[m]) for r in rs]) for m in measures} for k, rs in groups.items()}

    forecast = weather(paths["weather_forecast"], FORECAST, "forecast_datetime")
    raw = weather(paths["historical_weather"], MEASURED, "datetime")
    measured = {(c, t + day * (1 if t.hour < 11 else 2), b): v for (c, t, b), v in raw.items()}
    clients = {
        tuple(int(r[k]) for k in ("county", "is_business", "product_type", "data_block_id")): r
        for r in _read(paths["clients"])
    }
    gas = {int(r["data_block_id"]): r for r in _read(paths["gas"])}
    power = {(when(r["forecast_date"]) + day, int(r["data_block_id"])): r for r in _read(paths["electricity"])}
    train = {}
    for r in _read(paths["train"]):
        key = tuple(int(r[k]) for k in ("county", "is_business", "product_type", "is_consumption"))
        train[key, when(r["datetime"])] = (float(r["target"]) if r["target"] else None, int(r["data_block_id"]))
    ids = {k: i for i, k in enumerate(sorted({k for k, _ in train}))}

    out = {}
    for (key, t), (target, block) in train.items():
        c, b, p, k = key
        contract, g, e = clients.get((c, b, p, block)), gas.get(block), power.get((t, block))
        m, f = measured.get((c, t, block)), forecast.get((c, t, block))
        lags = [train.get((key, t - n * day), (None,))[0] for n in range(2, 8)]
        if None in (target, contract, g, e, m, f, *lags):
            continue
        row = {
            "client_id": ids[key],
            "target": target,
            "eic_count": int(contract["eic_count"]),
            "installed_capacity": float(contract["installed_capacity"]),
            "gas_mean_price_per_mhw": (float(g["lowest_price_per_mwh"]) + float(g["highest_price_per_mwh"])) / 2,
            "electricity_euros_per_mwh": float(e["euros_per_mwh"]),
            "product_type": {1: "Fixed", 2: "General service", 3: "Spot"}.get(p, "Unknown"),
            "sin(hour)": math.sin(2 * math.pi * t.hour / 24),
            "cos(weekday)": math.cos(2 * math.pi * t.isoweekday() / 7),
            "latitude_max": 57.9 if c == 0 else 58.2,
            "county_name_forecast": "Harju" if c == 0 else "Hiiu",
        }
        row |= {f"target_{n}_days_ago": v for n, v in zip(range(2, 8), lags)}
        row |= {x: m[x] for x in MEASURED}
        row |= {x if x not in MEASURED else f"{x}_forecast": f[x] for x in FORECAST}
        for x in FORECAST[1:]:
            seen = [v[x] for (c2, t2, b2), v in forecast.items() if (c2, b2) == (c, block) and t - day < t2 <= t]
            row[f"{x}_forecast_last_day"] = _mean(seen)
        for x in MEASURED:
            if x != "surface_pressure":
                for label, n in (("last_7_days", 7), ("last_24_hours", 1)):
                    seen = [v[x] for (c2, t2, _), v in measured.items() if c2 == c and t - n * day < t2 <= t]
                    row[f"{x}_{label}"] = _mean(seen)
        out[key, t] = row
    return out
