"""Golden mini-set: planted rows for the payroll rules and their expected results."""

from branchcost.schemas import EMPLOYEES, TIMESHEETS

GOLDEN_EMPLOYEES = [
    (1, 3, 7500000, "2018-08-23", ""),  # plain
    (9, 1, 13500000, "2017-12-22", "2019-08-01"),  # resigns on the 1st
    (33, 3, 9500000, "2019-08-29", ""),  # joins after the 28th
    (50, 1, 9500000, "2019-01-01", ""),  # duplicate; wins under string order
    (50, 1, 10000000, "2019-01-01", ""),  # duplicate; wins under numeric order
    (60, 2, 6000000, "2019-08-28", "2019-09-02"),  # both boundaries inside
    (70, None, 5000000, "2019-01-01", ""),  # null branch
]

GOLDEN_TIMESHEETS = [
    (101, 1, "2019-08-21", "08:00:00", "17:30:00"),  # 9.5 h
    (102, 1, "2019-08-22", "", "17:00:00"),  # blank checkin: 8 h
    (103, 1, "2019-08-23", "08:00:00", ""),  # blank checkout: 8 h
    (104, 1, "2019-08-24", "", ""),  # both blank: 8 h (literal union: 16 h)
    (105, 9, "2019-08-21", "22:00:00", "06:00:00"),  # overnight: 8 h
    (106, 9, "2019-08-22", "09:00:00", "09:00:00"),  # equal: 8 h
    (107, 50, "2019-08-21", "08:00:00", "12:00:00"),  # duplicate employee: 4 h
    (108, 60, "2019-08-28", "09:00:00", "09:00:12"),  # 12 seconds
    (109, 999, "2019-08-21", "08:00:00", "10:00:00"),  # no such employee
    (110, 70, "2019-09-02", "08:00:00", "16:30:00"),  # null branch
    (111, 50, "2019-09-03", "08:00:00", "18:00:00"),  # second month
    (112, 33, "2019-09-01", "07:45:30", "16:15:30"),  # seconds
]

EXPECTED_BRANCH_SALARY = {
    (1, 2019, 8): (20.0, 23500000, 1175000.0),
    (1, 2019, 9): (10.0, 10000000, 1000000.0),
    (2, 2019, 8): (0.0033333333333333335, 6000000, 1800000000.0),
    (3, 2019, 8): (33.5, 7500000, 223880.59701492538),
    (3, 2019, 9): (8.5, 9500000, 1117647.0588235294),
    (None, 2019, 8): (2.0, None, None),
    (None, 2019, 9): (8.5, None, None),
}

EXPECTED_LITERAL_DIFF = {(3, 2019, 8): (41.5, 7500000, 180722.89156626505)}

EXPECTED_SALARY_PERIOD = {
    (2019, 8, 1, 10000000),
    (2019, 8, 2, 6000000),
    (2019, 8, 3, 7500000),
    (2019, 8, None, 5000000),
    (2019, 9, 1, 10000000),
    (2019, 9, 2, 6000000),
    (2019, 9, 3, 17000000),
    (2019, 9, None, 5000000),
}


def golden_employees(spark):
    return spark.createDataFrame(GOLDEN_EMPLOYEES, EMPLOYEES)


def golden_timesheets(spark):
    return spark.createDataFrame(GOLDEN_TIMESHEETS, TIMESHEETS)


def as_dict(df, key_cols, value_cols):
    return {tuple(r[c] for c in key_cols): tuple(r[c] for c in value_cols) for r in df.collect()}
