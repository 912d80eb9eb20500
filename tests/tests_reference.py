"""Plain counting that tests compare with."""


def long_occupancy(rows, cap):
    """({(day, group): count}, the same by age first) of stays (person, onset, age, admit, discharge, ICU admit, ICU discharge) as day numbers."""

    def person_days(start, end):
        seen = {}
        for r in sorted(rows, key=lambda r: (r[3], r[1], r[2])):
            if r[start] is not None and r[end] is not None:
                for d in range(max(r[start], r[1]), min(r[end], r[1] + cap) + 1):
                    seen.setdefault((r[0], d), r[2])
        return seen

    hospital, icu = person_days(3, 4), person_days(5, 6)
    days = [d for _, d in hospital]
    plain, aged = {}, {}
    ages = set(hospital.values())
    for d in range(min(days), max(days)):
        n, i = sum(x == d for _, x in hospital), sum(x == d for _, x in icu)
        i = i if n else 0
        plain |= {(d, "ward"): float(n - i), (d, "ICU"): float(i)}
        for a in ages:
            n = sum(x == d and age == a for (_, x), age in hospital.items())
            i = sum(x == d and age == a for (_, x), age in icu.items()) if n else 0
            aged |= {(a, d, "ward"): float(n - i), (a, d, "ICU"): float(i)}
    return plain, aged
