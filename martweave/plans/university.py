"""Academic records: grades, rankings, enrolment, tuition, housing, and the pages built on them.

Course memberships are kept as rows (student, course), not as arrays on the student, so no
student or course can grow a row without bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.ladders import at_least, lookup
from ..functions.numbers import ceil_to
from ..functions.text import full_name
from ..operators.matching import match_by_rank
from ..operators.ranking import page, page_totals, top_per_group
from ..operators.running import ranked
from ..session import pin

POINT = "decimal(4,1)"


def grade_letter(percentage) -> Column:
    return at_least(percentage, [(t, g) for t, g, _ in V.GRADE_BANDS], V.GRADE_FAIL[0])


def grade_point(percentage) -> Column:
    points = at_least(percentage, [(t, p) for t, _, p in V.GRADE_BANDS], V.GRADE_FAIL[1])
    return points.cast(POINT)


def grade_marks(marks: DataFrame, mark: str = "mark") -> DataFrame:
    """Adds letter and points; a mark that is missing gets neither."""
    known = F.col(mark).isNotNull()
    return marks.withColumn("grade", F.when(known, grade_letter(mark))).withColumn(
        "grade_point", F.when(known, grade_point(mark))
    )


def study_year(enrollment_year) -> Column:
    year = F.col(enrollment_year) if isinstance(enrollment_year, str) else enrollment_year
    chain = F
    for entered, level in V.STUDY_YEARS.items():
        chain = chain.when(year == entered, level)
    return chain.otherwise(F.greatest(F.lit(1), F.least(F.lit(3), F.lit(2026) - year)))


def college_of(department) -> Column:
    table = {d: c for c, names in V.COLLEGE_DEPARTMENTS.items() for d in names}
    return lookup(department, table, V.UNKNOWN_COLLEGE)


def needed_credits(college) -> Column:
    return lookup(college, V.COLLEGE_CREDITS, 0)


def department_facts(departments: DataFrame) -> DataFrame:
    """Departments with college, credits needed and cost per credit."""
    college = college_of("department")
    compulsory = {c: cost for c, (cost, _) in V.COLLEGE_CREDIT_COST.items()}
    elective = {c: cost for c, (_, cost) in V.COLLEGE_CREDIT_COST.items()}
    return departments.withColumns(
        {
            "college": college,
            "needed_credits": needed_credits(college),
            "course_cost": lookup(college, compulsory, 0),
            "elective_cost": lookup(college, elective, 0),
        }
    )


def course_costs(courses: DataFrame, departments: DataFrame) -> DataFrame:
    """Courses with credits times the department's rate for their type."""
    rates = departments.select("department", "course_cost", "elective_cost")
    rate = F.when(F.col("type") == "Compulsory", F.col("course_cost")).when(
        F.col("type") == "Elective", F.col("elective_cost")
    )
    return courses.join(rates, "department", "left").select(
        *courses.columns, (F.col("credits") * rate).alias("cost")
    )


def gpa(transcript: DataFrame, courses: DataFrame) -> DataFrame:
    """Credit-weighted mean of grade points per student, two decimals; none without credits.

    Credits are matched to grades by course code; a grade for an unknown course counts nothing.
    """
    credits = courses.select(F.col("course_code").alias("course"), "credits")
    points = F.col("grade_point").cast(POINT)
    return (
        transcript.join(credits, "course", "inner")
        .groupBy("student_id")
        .agg(F.sum(points * F.col("credits")).alias("_points"), F.sum("credits").alias("_credits"))
        .filter(F.col("_credits") > 0)
        .select("student_id", F.round(F.col("_points") / F.col("_credits"), 2).cast("double").alias("gpa"))
    )


def fill_gpa(students: DataFrame, computed: DataFrame, only_missing: bool = False) -> DataFrame:
    """Students with their new GPA; with `only_missing` a stored value stays."""
    new = computed.select("student_id", F.col("gpa").alias("_gpa"))
    if "gpa" not in students.columns:
        students = students.withColumn("gpa", F.lit(None).cast("double"))
    stored, fresh = F.col("gpa"), F.col("_gpa")
    value = F.coalesce(stored, fresh) if only_missing else F.coalesce(fresh, stored)
    return students.join(new, "student_id", "left").withColumn("gpa", value).drop("_gpa")


def course_ratings(transcript: DataFrame, graded: DataFrame) -> DataFrame:
    """Mean grade points per course over students graded in it, rounded up to two decimals.

    `graded` lists (student_id, course_code); a course listed twice for a student still counts
    each of the student's grades once.
    """
    pairs = graded.select("student_id", F.col("course_code").alias("course")).distinct()
    mean = F.sum(F.col("grade_point").cast(POINT)) / F.count("grade_point")
    return (
        transcript.join(pairs, ["student_id", "course"], "left_semi")
        .groupBy("course")
        .agg(ceil_to(mean, 2).cast("double").alias("rating"))
    )


def rate_lecturers(employees: DataFrame, courses: DataFrame, ratings: DataFrame) -> DataFrame:
    """(course_code, instructor, employee_id, rating) for compulsory courses with a lecturer, joined on title."""
    compulsory = courses.filter(F.col("type") == "Compulsory").select("course_code", F.col("title").alias("course_title"))
    staff = employees.select(
        F.col("course").alias("course_title"), "employee_id", full_name("first_name", "last_name").alias("instructor")
    )
    scored = ratings.select(F.col("course").alias("course_code"), "rating")
    return (
        compulsory.join(staff, "course_title", "inner")
        .join(scored, "course_code", "inner")
        .select("course_code", "instructor", "employee_id", "rating")
    )


def grade_distribution(transcript: DataFrame) -> DataFrame:
    """Whole-percent share of A, B, C and D grades among passed ones."""
    counts = transcript.agg(
        *[F.count_if(F.col("grade").isin(*letters)).alias(name) for name, letters in V.GRADE_GROUPS]
    )
    total = sum((F.col(name) for name, _ in V.GRADE_GROUPS), start=F.lit(0))
    return counts.select(
        *[
            F.bround(F.try_divide(F.col(name) * 100, total), 0).cast("bigint").alias(name)
            for name, _ in V.GRADE_GROUPS
        ]
    )


def best_per_college_year(students: DataFrame, minimum: float = 3.25) -> DataFrame:
    """Student with the highest GPA per college and enrollment year, among those without an award."""
    eligible = students.filter((F.col("gpa") >= minimum) & F.col("award").isNull())
    return top_per_group(eligible, ["college", "enrollment_year"], [F.desc("gpa"), F.asc("student_id")], 1)


def best_of_college_per_year(students: DataFrame, college: str = "CHSS", minimum: float = 3.0, n: int = 2) -> DataFrame:
    eligible = students.filter(
        (F.col("college") == college) & (F.col("gpa") >= minimum) & F.col("scholarship").isNull()
    )
    return top_per_group(eligible, ["enrollment_year"], [F.desc("gpa"), F.asc("student_id")], n, "rank")


def scholarship_candidates(students: DataFrame, test: Column, minimum: float, n: int) -> DataFrame:
    """The `n` best students by GPA among those passing `test` and without a scholarship."""
    eligible = students.filter(test & (F.col("gpa") >= minimum) & F.col("scholarship").isNull())
    return eligible.orderBy(F.desc("gpa"), "student_id").limit(n)


def engineering_scholarship(students: DataFrame, year: int = 2020) -> DataFrame:
    test = (
        (F.col("gender") == "Female")
        & (F.col("enrollment_year") == year)
        & F.col("department").isin(*V.ENGINEERING_DEPARTMENTS)
    )
    return scholarship_candidates(students, test, 3.5, 2)


def diversity_scholarship(students: DataFrame, year: int = 2023) -> DataFrame:
    abroad = F.coalesce(F.col("country") != "United States", F.lit(True))
    return scholarship_candidates(students, abroad & (F.col("enrollment_year") == year), 3.0, 5)


def minority_scholarship(students: DataFrame, year: int = 2023) -> DataFrame:
    """The race test compares with lower-case 'white' as defined; values are stored capitalised."""
    test = (
        (F.col("country") == "United States")
        & (F.col("enrollment_year") == year)
        & F.coalesce(F.col("race") != "white", F.lit(True))
    )
    return scholarship_candidates(students, test, 3.0, 5)


def _first_of_department(courses: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """(course_code, zero-based position) of the first `n` courses of each department.

    Only these leave the tasks; the rest of a large department is never sorted in one place.
    """
    return top_per_group(courses, ["department"], order, n, "_r").select(
        "course_code", (F.col("_r") - 1).alias("_i")
    )


def course_slots(courses: DataFrame, order: Sequence[Column], years: int = 3, per_year: int = 6) -> DataFrame:
    """Compulsory courses with year and semester (four, then two per year), all others elective."""
    placed = _first_of_department(courses, order, years * per_year)
    base = courses.drop("type", "year", "semester")
    i = F.col("_i")
    return base.join(placed, "course_code", "left").select(
        *base.columns,
        F.when(i.isNotNull(), "Compulsory").otherwise("Elective").alias("type"),
        (F.floor(i / per_year) + 1).cast("int").alias("year"),
        (F.floor((i % per_year) / 4) + 1).cast("int").alias("semester"),
    )


def course_years(courses: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Year of each compulsory course: first three, next three, next two of a department, then the rest."""
    compulsory = courses.filter(F.col("type") == "Compulsory").drop("year")
    placed = _first_of_department(compulsory, order, 8)
    i = F.col("_i")
    year = F.when(i < 3, 1).when(i < 6, 2).when(i < 8, 3).otherwise(4)
    return compulsory.join(placed, "course_code", "left").select(*compulsory.columns, year.alias("year"))


def course_types(courses: DataFrame, order: Sequence[Column], n: int = 10) -> DataFrame:
    """First `n` courses of a department are compulsory, the rest elective."""
    placed = _first_of_department(courses, order, n)
    base = courses.drop("type")
    return base.join(placed, "course_code", "left").select(
        *base.columns, F.when(F.col("_i").isNotNull(), "Compulsory").otherwise("Elective").alias("type")
    )


def level_electives(courses: DataFrame, credits: int = 3) -> DataFrame:
    """All electives get the same credits."""
    value = F.when(F.col("type") == "Elective", F.lit(credits)).otherwise(F.col("credits"))
    return courses.withColumn("credits", value)


def enrol_compulsory(students: DataFrame, courses: DataFrame, semester: int = 1) -> DataFrame:
    """(student_id, course_code) for the compulsory courses of the student's department and year."""
    due = courses.filter((F.col("type") == "Compulsory") & (F.col("semester") == semester)).select(
        "department", "year", "course_code"
    ).distinct()
    return students.select("student_id", "department", "year").join(due, ["department", "year"], "inner").select(
        "student_id", "course_code"
    )


def enrol_electives(students: DataFrame, courses: DataFrame, pick: Column, k: int = 1) -> DataFrame:
    """(student_id, course_code) for `k` electives of the student's department.

    Electives of a department are numbered once; a student takes the `k` that follow the
    number `pick` (any integer expression over the student) around the list.  No student is
    joined to the whole list, so nothing grows with students times courses.
    """
    offered = ranked(
        courses.filter(F.col("type") == "Elective").select("department", "course_code", "course_no"),
        ["department"],
        ["course_no"],
        "_no",
    )
    sizes = offered.groupBy("department").agg(F.count(F.lit(1)).alias("_size"))
    wanted = (
        students.select("student_id", "department", pick.cast("bigint").alias("_pick"))
        .join(sizes, "department", "inner")
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.least(F.lit(k), F.col("_size")) - 1)))
        .withColumn("_no", F.pmod(F.col("_pick") + F.col("_step"), F.col("_size")) + 1)
    )
    return wanted.join(offered.drop("course_no"), ["department", "_no"], "inner").select("student_id", "course_code")


def count_per(parents: DataFrame, key: str, children: DataFrame, child_key: str, name: str) -> DataFrame:
    """Parents with the number of their children, 0 where there are none.

    Children are counted before the join, so a parent with very many is one row by then.
    """
    counts = children.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias(key)).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return parents.join(counts, key, "left").select(
        *[c for c in parents.columns if c != name], F.coalesce("_n", F.lit(0)).alias(name)
    )


def member_pages(members: DataFrame, group: str, member_no: str, member_id: str, size: int = 1000) -> DataFrame:
    """Members per group as lists of at most `size` ids in `member_no` order, numbered from 1.

    A group within `size` is one list; a larger one is spread over several rows, all kept.
    """
    numbered = ranked(members.select(group, member_no, member_id), [group], [member_no], "_r")
    paged = numbered.withColumn("page_no", (F.floor((F.col("_r") - 1) / size) + 1).cast("bigint"))
    return paged.groupBy(group, "page_no").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col("_r"), F.col(member_id).alias("id")))), lambda x: x["id"]
        ).alias("members"),
        F.count(F.lit(1)).alias("member_count"),
    )


def department_faculty(employees: DataFrame, size: int = 1000) -> DataFrame:
    teaching = employees.filter(F.col("position").isin(*V.FACULTY_POSITIONS))
    return member_pages(teaching, "department", "employee_no", "employee_id", size)


def department_heads(departments: DataFrame, employees: DataFrame) -> DataFrame:
    """Departments by name with the name of their head, null without one."""
    heads = employees.select(
        F.col("employee_id").alias("head_of_department"), full_name("first_name", "last_name").alias("_name")
    )
    return (
        departments.join(heads, "head_of_department", "left")
        .withColumn("head_of_department", F.col("_name"))
        .select(*departments.columns)
        .orderBy("department")
    )


def catalogue(departments: DataFrame) -> DataFrame:
    """(college, department) of the four colleges, in order."""
    return (
        departments.filter(F.col("college").isin(*V.COLLEGES)).select("college", "department").orderBy("college", "department")
    )


def tuition_statement(
    students: DataFrame, graded: DataFrame, courses: DataFrame, rooms: DataFrame, awards: DataFrame
) -> DataFrame:
    """Course cost, aid, balance and rent per student.

    `graded` is (student_id, course_code, kind) with kind 'course' or 'elective'.  Rent is
    reported but not part of the balance.
    """
    priced = graded.join(courses.select("course_code", "cost"), "course_code", "inner")
    costs = priced.groupBy("student_id").agg(
        F.sum(F.when(F.col("kind") == "course", F.col("cost")).otherwise(0)).alias("_courses"),
        F.sum(F.when(F.col("kind") == "elective", F.col("cost")).otherwise(0)).alias("_electives"),
    )
    rents = rooms.select(F.col("room_id").alias("housing"), F.col("rent").alias("_rent"))

    def aid(kind: str) -> DataFrame:
        return awards.select(F.col("name").alias(kind), F.col("amount").alias(f"_{kind}_amount"))

    def matched(rows: DataFrame, key: str, table: DataFrame, known: Column) -> DataFrame:
        """Left join in one pass.  Rows that cannot match (nulls and the like) get a null key and
        are spread by student, so they do not meet in one task."""
        spread = F.when(known, F.xxhash64(key)).otherwise(F.xxhash64("student_id"))
        left = rows.select("*", F.when(known, F.col(key)).alias("_key"), spread.alias("_spread"))
        right = table.select(F.col(key).alias("_key"), F.xxhash64(key).alias("_spread"), *[c for c in table.columns if c != key])
        return left.join(right, ["_key", "_spread"], "left").drop("_key", "_spread")

    joined = students.select("student_id", "housing", "award", "scholarship").join(costs, "student_id", "left")
    has_room = F.col("housing").isNotNull() & ~F.col("housing").isin(V.HOUSING_PENDING, V.HOUSING_EXTERNAL)
    joined = matched(joined, "housing", rents, F.coalesce(has_room, F.lit(False)))
    for kind in ("award", "scholarship"):
        joined = matched(joined, kind, aid(kind), F.col(kind).isNotNull())

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    def aid_entry(kind: str) -> Column:
        amount = F.col(f"_{kind}_amount")
        return F.when(
            amount.isNotNull(), F.struct(F.col(kind).alias("name"), amount.alias("amount"))
        ).alias(kind)

    has_aid = F.col("_award_amount").isNotNull() | F.col("_scholarship_amount").isNotNull()
    tuition = zero("_courses") + zero("_electives")
    return joined.select(
        "student_id",
        (tuition - zero("_award_amount") - zero("_scholarship_amount")).alias("balance"),
        F.struct(zero("_electives").alias("electives"), zero("_courses").alias("courses")).alias("tuition"),
        F.when(F.col("housing").isin(V.HOUSING_PENDING, V.HOUSING_EXTERNAL), F.lit(0))
        .otherwise(zero("_rent"))
        .alias("housing"),
        F.when(has_aid, F.struct(aid_entry("award"), aid_entry("scholarship"))).alias("financial_aid"),
    )


def _free_beds(rooms: DataFrame) -> DataFrame:
    return rooms.filter(F.col("capacity") > 0).select(
        "campus", "type", "room_no", "room_id", F.explode(F.sequence(F.lit(1), F.col("capacity").cast("int"))).alias("bed")
    )


def allocate_housing(
    students: DataFrame, rooms: DataFrame, choose_type, retry_campuses: Sequence[str]
) -> DataFrame:
    """(student_id, student_no, campus, housing) after three rounds of first-fit.

    `choose_type(round)` gives the type a student asks for.  Round 1 takes all students, the
    rest is 'Pending'; round 2 takes pending students of `retry_campuses`, the rest of them is
    'External Housing'; round 3 takes those again.
    """
    group, seeker_order, place_order = ["campus", "type"], ["student_no"], ["room_no", "bed"]
    columns = ["student_id", "student_no", "campus"]

    def round_of(number: int, seekers: DataFrame, beds: DataFrame) -> tuple[DataFrame, DataFrame]:
        asking = seekers.withColumn("type", choose_type(number))
        matched = pin(
            match_by_rank(asking, beds, group, seeker_order, place_order, ["room_no", "room_id", "bed"]),
            f"housing-round-{number}",
        )
        taken = matched.filter(F.col("room_no").isNotNull()).select("room_no", "bed")
        return matched, beds.join(taken, ["room_no", "bed"], "left_anti")

    beds = _free_beds(rooms)
    # each round is written once: the later rounds and the result all read it
    first, beds = round_of(1, students.select(*columns), beds)
    placed1 = first.filter(F.col("room_id").isNotNull())
    pending = first.filter(F.col("room_id").isNull()).select(*columns)
    waiting = pending.filter(~F.col("campus").isin(*retry_campuses))
    second, beds = round_of(2, pending.filter(F.col("campus").isin(*retry_campuses)), beds)
    placed2 = second.filter(F.col("room_id").isNotNull())
    third, _ = round_of(3, second.filter(F.col("room_id").isNull()).select(*columns), beds)

    def result(df: DataFrame, housing: Column) -> DataFrame:
        return df.select(*columns, housing.alias("housing"))

    return (
        result(placed1, F.col("room_id"))
        .unionByName(result(waiting, F.lit(V.HOUSING_PENDING)))
        .unionByName(result(placed2, F.col("room_id")))
        .unionByName(result(third, F.coalesce("room_id", F.lit(V.HOUSING_EXTERNAL))))
    )


def room_occupancy(rooms: DataFrame, allocation: DataFrame) -> DataFrame:
    """Rooms with occupants, places left and status."""
    empty, partly, full = V.ROOM_STATUSES
    counted = count_per(rooms, "room_id", allocation, "housing", "occupants")
    left = F.col("capacity") - F.col("occupants")
    status = F.when(F.col("occupants") == 0, empty).when(left > 0, partly).otherwise(full)
    return counted.select("room_id", "campus", "type", "capacity", "occupants", left.alias("left"), status.alias("status"))


def students_page(students: DataFrame, number: int = 1, college: str | None = None, year: int | None = None, size: int = 10) -> DataFrame:
    """One page of students by name, optionally of one college and enrollment year."""
    return page(_filtered(students, college=college, enrollment_year=year), ["last_name", "first_name", "student_id"], number, size)


def students_totals(students: DataFrame, college: str | None = None, year: int | None = None, size: int = 10) -> DataFrame:
    return page_totals(_filtered(students, college=college, enrollment_year=year), size)


def rooms_page(
    rooms: DataFrame, number: int = 1, status: str | None = None, kind: str | None = None,
    campus: str | None = None, size: int = 20,
) -> DataFrame:
    return page(_filtered(rooms, status=status, type=kind, campus=campus), ["rent", "room_id"], number, size)


def _filtered(df: DataFrame, **wanted) -> DataFrame:
    for name, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df


def find_student(students: DataFrame, student_id: str, email: str) -> DataFrame:
    return students.filter((F.col("student_id") == student_id) & (F.col("email") == email))


def transcript_page(student_id: str, graded: DataFrame, courses: DataFrame, transcript: DataFrame) -> DataFrame:
    """Courses of one student in listed order with title, grade and points.

    `graded` is (student_id, course_code, kind, pos).  A course graded more than once shows
    the smallest grade entry, one line per listed course.
    """
    mine = graded.filter(F.col("student_id") == student_id).select("kind", "pos", "course_code")
    titles = courses.select("course_code", "title")
    grades = (
        transcript.filter(F.col("student_id") == student_id)
        .groupBy(F.col("course").alias("course_code"))
        .agg(F.min(F.struct("grade", "grade_point")).alias("_g"))
    )
    return (
        mine.join(titles, "course_code", "inner")
        .join(grades, "course_code", "inner")
        .select(
            "kind",
            "pos",
            F.col("course_code").alias("course_id"),
            F.col("title").alias("course_name"),
            F.col("_g.grade").alias("course_grade"),
            F.col("_g.grade_point").alias("course_grade_point"),
        )
        .orderBy("kind", "pos")
    )


def assign_advisors(students: DataFrame, advisors: DataFrame, pick: Column) -> DataFrame:
    """Students with an advisor of their campus: the one whose number follows `pick` around the list."""
    listed = ranked(advisors.select("campus", "advisor_no", "employee_id"), ["campus"], ["advisor_no"], "_no")
    sizes = listed.groupBy("campus").agg(F.count(F.lit(1)).alias("_size"))
    wanted = students.join(sizes, "campus", "inner").withColumn(
        "_no", F.pmod(pick.cast("bigint"), F.col("_size")) + 1
    )
    return wanted.join(listed.drop("advisor_no"), ["campus", "_no"], "inner").select(
        *students.columns, F.col("employee_id").alias("advisor")
    )
