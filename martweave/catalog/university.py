"""Registered university queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.text import full_name
from ..operators.ranking import page_after, page_totals
from ..plans import university as U
from ..plans import velocity
from . import standins as S
from .common import Catalog, big, dbl, literal, plain, quoted, rounded

catalog = Catalog()


def students(spark, folder):
    return S.STUDENTS.frame(spark, folder)


def courses(spark, folder):
    return S.COURSES.frame(spark, folder)


def transcript(spark, folder):
    return U.grade_marks(S.TRANSCRIPT.frame(spark, folder))


def rooms(spark, folder):
    return S.ROOMS.frame(spark, folder)


def employees(spark, folder):
    return S.EMPLOYEES.frame(spark, folder)


def departments(spark, folder):
    """Departments that occur among the students, each with the lowest-numbered head, if any."""
    heads = (
        employees(spark, folder)
        .filter(F.col("position") == V.HEAD_POSITION)
        .groupBy("department")
        .agg(F.min_by("employee_id", "employee_no").alias("head_of_department"))
    )
    names = students(spark, folder).select("department").distinct()
    return U.department_facts(names.join(heads, "department", "left"))


def graded_rows(spark, folder):
    return transcript(spark, folder).select("student_id", F.col("course").alias("course_code"), "kind", "pos")


def _bands_sql(value: str, pick: int, default: str, kind: str) -> str:
    arms = " ".join(f"when {value} >= {band[0]} then {literal(band[pick]) if kind == 'varchar' else band[pick]}" for band in V.GRADE_BANDS)
    return f"cast(case {arms} else {default} end as {kind})"


_TRANSCRIPT_SQL = f"""(select *, {_bands_sql('mark', 1, literal(V.GRADE_FAIL[0]), 'varchar')} grade,
  {_bands_sql('mark', 2, V.GRADE_FAIL[1], 'decimal(4,1)')} grade_point from {S.TRANSCRIPT.sql})"""


@catalog.add(
    "graded_marks",
    f"""select student_id, course, mark, kind, {big('pos')} pos, grade, {dbl('grade_point')} grade_point from {_TRANSCRIPT_SQL}""",
)
def _(spark, folder):
    return plain(transcript(spark, folder))


@catalog.add(
    "grade_table",
    f"select mark percentage, grade, {dbl('grade_point')} grade_point, count(*) n from {_TRANSCRIPT_SQL} group by all",
)
def _(spark, folder):
    """Grade row of every percentage that occurs."""
    marks = S.TRANSCRIPT.frame(spark, folder).groupBy(F.col("mark").alias("percentage")).agg(F.count(F.lit(1)).alias("n"))
    return plain(U.grade_marks(marks, "percentage"))


_GPA_SQL = f"""(select student_id, {rounded('sum(grade_point * credits) / sum(credits)', 2)} gpa
  from {_TRANSCRIPT_SQL} t join {S.COURSES.sql} c on c.course_code = t.course group by student_id having sum(credits) > 0)"""


@catalog.add("gpa", f"select * from {_GPA_SQL}")
def _(spark, folder):
    return plain(U.gpa(transcript(spark, folder), courses(spark, folder)))


def with_gpa(spark, folder):
    return U.fill_gpa(students(spark, folder), U.gpa(transcript(spark, folder), courses(spark, folder)))


_STUDENTS_SQL = f"(select s.*, gpa from {S.STUDENTS.sql} s left join {_GPA_SQL} g on g.student_id = s.student_id)"


@catalog.add(
    "gpa_second_pass",
    f"select s.student_id, coalesce(if(student_no % 3 = 0, 1.5, null), gpa)::double gpa from {_STUDENTS_SQL} s",
)
def _(spark, folder):
    """A stored GPA stays, a missing one is filled."""
    stored = students(spark, folder).withColumn("gpa", F.when(F.col("student_no") % 3 == 0, F.lit(1.5)))
    filled = U.fill_gpa(stored, U.gpa(transcript(spark, folder), courses(spark, folder)), only_missing=True)
    return plain(filled.select("student_id", "gpa"))


@catalog.add(
    "course_rating",
    f"""select course, {dbl('ceil(sum(grade_point) * 100 / count(*)) / 100')} rating from {_TRANSCRIPT_SQL} group by course""",
)
def _(spark, folder):
    rows = transcript(spark, folder)
    return plain(U.course_ratings(rows, graded_rows(spark, folder)))


_STAFF_SQL = f"""(select *, 'C' || (employee_no * 3) code from {S.EMPLOYEES.sql})"""


@catalog.add(
    "lecturer_rating",
    f"""select course_code, e.first_name || ' ' || e.last_name instructor, employee_id,
    {dbl('ceil(points * 100 / n) / 100')} rating from {S.COURSES.sql} c join {_STAFF_SQL} e on e.code = c.course_code
    join (select course, sum(grade_point) points, count(*) n from {_TRANSCRIPT_SQL} group by course) r on r.course = c.course_code
    where c.type = 'Compulsory'""",
)
def _(spark, folder):
    titles = courses(spark, folder).select("course_code", F.col("title").alias("course"))
    code = F.concat(F.lit("C"), (F.col("employee_no") * 3).cast("string"))
    staff = employees(spark, folder).withColumn("course_code", code).join(titles, "course_code")
    ratings = U.course_ratings(transcript(spark, folder), graded_rows(spark, folder))
    return plain(U.rate_lecturers(staff, courses(spark, folder), ratings))


_GROUP_COUNTS = ", ".join(f"count(*) filter (grade in ({quoted(g)})) {n}" for n, g in V.GRADE_GROUPS)
_GROUP_SUM = " + ".join(n for n, _ in V.GRADE_GROUPS)


@catalog.add(
    "grade_distribution",
    f"select {', '.join(f'{big(f'round_even({n} * 100 / ({_GROUP_SUM}), 0)')} {n}' for n, _ in V.GRADE_GROUPS)} from (select {_GROUP_COUNTS} from {_TRANSCRIPT_SQL})",
)
def _(spark, folder):
    return plain(U.grade_distribution(transcript(spark, folder)))


@catalog.add(
    "global_counts",
    f"""select (select count(*) from {S.STUDENTS.sql}) total_students, (select count(distinct department) from {S.STUDENTS.sql}) total_departments""",
)
def _(spark, folder):
    return plain(
        students(spark, folder).agg(
            F.count(F.lit(1)).alias("total_students"), F.countDistinct("department").alias("total_departments")
        )
    )


# --- rankings -------------------------------------------------------------------------------


@catalog.add(
    "top_per_college_year",
    f"""select student_id, college, {big('enrollment_year')} enrollment_year, gpa from (select *,
    row_number() over (partition by college, enrollment_year order by gpa desc, student_id) r from {_STUDENTS_SQL}
    where gpa >= 3.25 and award is null) where r = 1""",
)
def _(spark, folder):
    best = U.best_per_college_year(with_gpa(spark, folder))
    return plain(best.select("student_id", "college", "enrollment_year", "gpa"))


@catalog.add(
    "top2_per_year",
    f"""select student_id, {big('enrollment_year')} enrollment_year, gpa, r "rank" from (select *,
    row_number() over (partition by enrollment_year order by gpa desc, student_id) r from {_STUDENTS_SQL}
    where gpa >= 3.0 and scholarship is null and college = 'CHSS') where r <= 2""",
)
def _(spark, folder):
    best = U.best_of_college_per_year(with_gpa(spark, folder))
    return plain(best.select("student_id", "enrollment_year", "gpa", "rank"))


def _best_sql(test: str, minimum: float, n: int) -> str:
    return f"""select student_id, gpa from {_STUDENTS_SQL} where scholarship is null and gpa >= {minimum} and {test}
    order by gpa desc, student_id limit {n}"""


_ENGINEERING = f"gender = 'Female' and department in ({quoted(V.ENGINEERING_DEPARTMENTS)})"


@catalog.add("scholarship_engineering", _best_sql(f"enrollment_year = 2020 and {_ENGINEERING}", 3.5, 2))
def _(spark, folder):
    return plain(U.engineering_scholarship(with_gpa(spark, folder)).select("student_id", "gpa"))


@catalog.add(
    "scholarship_diversity", _best_sql("enrollment_year = 2023 and country is distinct from 'United States'", 3.0, 5)
)
def _(spark, folder):
    return plain(U.diversity_scholarship(with_gpa(spark, folder)).select("student_id", "gpa"))


@catalog.add(
    "scholarship_minority",
    _best_sql("enrollment_year = 2023 and country = 'United States' and race is distinct from 'white'", 3.0, 5),
)
def _(spark, folder):
    return plain(U.minority_scholarship(with_gpa(spark, folder)).select("student_id", "gpa"))


# --- courses -----------------------------------------------------------------------------------

_SHUFFLED = "((course_no % 1000003) * 7919 + 11) % 1000003"


def shuffled():
    return [((F.col("course_no") % 1000003) * 7919 + 11) % 1000003, F.col("course_no")]


@catalog.add(
    "course_slots",
    f"""select course_code, department, if(i < 18, 'Compulsory', 'Elective') type,
    if(i < 18, i // 6 + 1, null)::bigint "year", if(i < 18, i % 6 // 4 + 1, null)::bigint semester
    from (select *, row_number() over (partition by department order by {_SHUFFLED}, course_no) - 1 i from {S.COURSES.sql})""",
)
def _(spark, folder):
    slots = U.course_slots(courses(spark, folder), shuffled())
    return plain(slots.select("course_code", "department", "type", "year", "semester"))


@catalog.add(
    "course_years",
    f"""select course_code, case when r <= 3 then 1 when r <= 6 then 2 when r <= 8 then 3 else 4 end::bigint "year"
    from (select *, row_number() over (partition by department order by course_no) r from {S.COURSES.sql} where type = 'Compulsory')""",
)
def _(spark, folder):
    return plain(U.course_years(courses(spark, folder), [F.col("course_no")]).select("course_code", "year"))


@catalog.add(
    "course_types",
    f"""select course_code, if(r <= 10, 'Compulsory', 'Elective') type, if(r <= 10, {big('credits')}, 3) credits
    from (select *, row_number() over (partition by department order by course_no) r from {S.COURSES.sql})""",
)
def _(spark, folder):
    typed = U.level_electives(U.course_types(courses(spark, folder), [F.col("course_no")]))
    return plain(typed.select("course_code", "type", "credits"))


def _case_sql(value: str, table: dict, default) -> str:
    return f"case {value} " + " ".join(f"when '{k}' then {literal(v)}" for k, v in table.items()) + f" else {default} end"


_COMPULSORY_COST = _case_sql("college", {c: a for c, (a, _) in V.COLLEGE_CREDIT_COST.items()}, 0)
_ELECTIVE_COST = _case_sql("college", {c: b for c, (_, b) in V.COLLEGE_CREDIT_COST.items()}, 0)
_COURSES_SQL = f"""(select c.*, {big(f"credits * if(type = 'Compulsory', {_COMPULSORY_COST}, {_ELECTIVE_COST})")} as cost
  from {S.COURSES.sql} c join (select distinct department, college from {S.STUDENTS.sql}) d on d.department = c.department)"""


@catalog.add("course_cost", f"select course_code, department, type, {big('credits')} credits, cost from {_COURSES_SQL}")
def _(spark, folder):
    priced = U.course_costs(courses(spark, folder), departments(spark, folder))
    return plain(priced.select("course_code", "department", "type", "credits", "cost"))


_HEADS_SQL = f"""(select department, arg_min(first_name || ' ' || last_name, employee_no) head from {S.EMPLOYEES.sql}
  where position = '{V.HEAD_POSITION}' group by department)"""


@catalog.add(
    "department_heads",
    f"""select d.department, college, {big(_case_sql('college', V.COLLEGE_CREDITS, 0))} needed_credits,
    {big(_COMPULSORY_COST)} course_cost, {big(_ELECTIVE_COST)} elective_cost, head head_of_department
    from (select distinct department, college from {S.STUDENTS.sql}) d left join {_HEADS_SQL} h on h.department = d.department""",
)
def _(spark, folder):
    return plain(U.department_heads(departments(spark, folder), employees(spark, folder)))


@catalog.add(
    "catalogue",
    f"""select distinct college, department from {S.STUDENTS.sql} where college in ({quoted(V.COLLEGES)})""",
)
def _(spark, folder):
    return plain(U.catalogue(departments(spark, folder)))


@catalog.add(
    "department_students",
    f"""select department, count(*) students from {S.STUDENTS.sql} group by department""",
)
def _(spark, folder):
    names = students(spark, folder).select("department").distinct()
    return plain(U.count_per(names, "department", students(spark, folder), "department", "students"))


@catalog.add(
    "course_enrolment_counts",
    f"""select course_code, count(course) students from {S.COURSES.sql} left join {_TRANSCRIPT_SQL} t on t.course = course_code
    group by course_code""",
)
def _(spark, folder):
    codes = courses(spark, folder).select("course_code")
    return plain(U.count_per(codes, "course_code", graded_rows(spark, folder), "course_code", "students"))


@catalog.add(
    "department_faculty",
    f"""select department, (r - 1) // 4 + 1 page_no, string_agg(employee_id, ',' order by r) members, count(*) member_count
    from (select *, row_number() over (partition by department order by employee_no) r from {S.EMPLOYEES.sql}
      where position in ({quoted(V.FACULTY_POSITIONS)})) group by department, (r - 1) // 4""",
)
def _(spark, folder):
    return plain(U.department_faculty(employees(spark, folder), size=4))


@catalog.add(
    "department_courses",
    f"""select department, (r - 1) // 50 + 1 page_no, string_agg(course_code, ',' order by r) members, count(*) member_count
    from (select *, row_number() over (partition by department order by course_no) r from {S.COURSES.sql}) group by department, (r - 1) // 50""",
)
def _(spark, folder):
    return plain(U.member_pages(courses(spark, folder), "department", "course_no", "course_code", size=50))


# --- enrolment ----------------------------------------------------------------------------------

_SLOTS_SQL = f"""(select course_code, department, i // 6 + 1 slot_year, i % 6 // 4 + 1 slot_semester
  from (select *, row_number() over (partition by department order by {_SHUFFLED}, course_no) - 1 i from {S.COURSES.sql}) where i < 18)"""
_YEAR_SQL = "case enrollment_year when 2025 then 1 when 2024 then 2 when 2023 then 3 else greatest(1, least(3, 2026 - enrollment_year)) end"


@catalog.add(
    "study_year",
    f"""select student_id, {big(_YEAR_SQL)} "year", college, department from {S.STUDENTS.sql}""",
)
def _(spark, folder):
    rows = students(spark, folder).drop("college")
    return plain(
        rows.select("student_id", U.study_year("enrollment_year").alias("year"), U.college_of("department").alias("college"), "department")
    )


@catalog.add(
    "enrol_compulsory",
    f"""select student_id, course_code from (select *, {_YEAR_SQL} study from {S.STUDENTS.sql}) s
    join {_SLOTS_SQL} c on c.department = s.department and slot_year = study and slot_semester = 1""",
)
def _(spark, folder):
    """First-semester courses of the timetable, four per department and year."""
    rows = students(spark, folder).withColumn("year", U.study_year("enrollment_year"))
    return plain(U.enrol_compulsory(rows, U.course_slots(courses(spark, folder), shuffled())))


_STUDENT_PICK = "((student_no % 1000003) * 7919 + 5) % 1000003"


@catalog.add(
    "enrol_electives",
    f"""with offered as (select department, course_code, row_number() over (partition by department order by course_no) r,
      count(*) over (partition by department) size from {S.COURSES.sql} where type = 'Elective')
    select student_id, course_code from {S.STUDENTS.sql} s join offered o on o.department = s.department
    and (r - 1 - {_STUDENT_PICK} % size + size) % size < 2""",
)
def _(spark, folder):
    pick = ((F.col("student_no") % 1000003) * 7919 + 5) % 1000003
    return plain(U.enrol_electives(students(spark, folder), courses(spark, folder), pick, 2))


@catalog.add(
    "advisor_load",
    f"""with listed as (select campus, employee_id, row_number() over (partition by campus order by employee_no) r,
      count(*) over (partition by campus) size from {S.EMPLOYEES.sql})
    select l.employee_id, count(s.student_id) students from listed l left join {S.STUDENTS.sql} s
    on s.campus = l.campus and s.student_no % size = r - 1 group by l.employee_id""",
)
def _(spark, folder):
    """Students per advisor, idle advisors kept."""
    staff = employees(spark, folder).withColumn("advisor_no", F.col("employee_no"))
    assigned = U.assign_advisors(students(spark, folder), staff, F.col("student_no"))
    return plain(U.count_per(staff.select("employee_id"), "employee_id", assigned, "advisor", "students"))


# --- money -------------------------------------------------------------------------------------

AWARDS = [("Merit Award", 4500), ("Travel Grant", 5500)]


def statements(spark, folder):
    priced = U.course_costs(courses(spark, folder), departments(spark, folder))
    awards = spark.createDataFrame(AWARDS, "name string, amount int")
    return U.tuition_statement(
        students(spark, folder), graded_rows(spark, folder), priced, rooms(spark, folder), awards
    )


_AWARDS_SQL = "(values " + ", ".join(f"('{n}', {a})" for n, a in AWARDS) + ") a(name, amount)"
_STATEMENT_SQL = f"""(select s.student_id, coalesce(c, 0) courses, coalesce(e, 0) electives, a.amount award_amount, g.amount grant_amount,
    s.award, s.scholarship, if(s.housing in ('{V.HOUSING_PENDING}', '{V.HOUSING_EXTERNAL}'), 0, coalesce(rent, 0)) rent,
    coalesce(c, 0) + coalesce(e, 0) - coalesce(a.amount, 0) - coalesce(g.amount, 0) balance
  from {S.STUDENTS.sql} s
  left join (select student_id, sum(cost) filter (kind = 'course') c, sum(cost) filter (kind = 'elective') e
    from {_TRANSCRIPT_SQL} t join {_COURSES_SQL} p on p.course_code = t.course group by student_id) k on k.student_id = s.student_id
  left join {S.ROOMS.sql} r on r.room_id = s.housing
  left join {_AWARDS_SQL} on a.name = s.award left join {_AWARDS_SQL.replace(' a(', ' g(')} on g.name = s.scholarship)"""


@catalog.add(
    "tuition_statement",
    f"""select student_id, {big('balance')} balance, {big('electives')} tuition_electives, {big('courses')} tuition_courses,
    {big('rent')} housing, if(award_amount is null, null, award) award_name, {big('award_amount')} award_amount,
    if(grant_amount is null, null, scholarship) scholarship_name, {big('grant_amount')} scholarship_amount,
    award_amount is not null or grant_amount is not null has_aid from {_STATEMENT_SQL}""",
)
def _(spark, folder):
    rows = statements(spark, folder)
    return plain(
        rows.select(
            "student_id",
            "balance",
            F.col("tuition.electives").alias("tuition_electives"),
            F.col("tuition.courses").alias("tuition_courses"),
            "housing",
            F.col("financial_aid.award.name").alias("award_name"),
            F.col("financial_aid.award.amount").alias("award_amount"),
            F.col("financial_aid.scholarship.name").alias("scholarship_name"),
            F.col("financial_aid.scholarship.amount").alias("scholarship_amount"),
            F.col("financial_aid").isNotNull().alias("has_aid"),
        )
    )


@catalog.add(
    "enrolment_status",
    f"""select t.student_id, t.course, case when balance is null then 'applied' when balance <= 100000 then 'enrolled' else 'processing' end status
    from {_TRANSCRIPT_SQL} t left join {_STATEMENT_SQL} s on s.student_id = t.student_id""",
)
def _(spark, folder):
    applications = transcript(spark, folder).select("student_id", "course")
    return plain(velocity.enrolment_status(applications, statements(spark, folder), 100000))


# --- housing ------------------------------------------------------------------------------------

RETRY_CAMPUS = "Campus 3"


def asked_type(number: int):
    step = (F.col("student_no") * 7 + number * 3) % len(V.HOUSING_TYPES)
    return F.array(*[F.lit(t) for t in V.HOUSING_TYPES])[step.cast("int")]


def allocation(spark, folder):
    return U.allocate_housing(students(spark, folder), rooms(spark, folder), asked_type, [RETRY_CAMPUS])


def _asked_sql(number: int) -> str:
    return f"[{quoted(V.HOUSING_TYPES)}][(student_no * 7 + {number * 3}) % {len(V.HOUSING_TYPES)} + 1]"


def _round_sql(number: int, seekers: str, beds: str) -> str:
    return f"""s{number} as (select student_id, student_no, campus, {_asked_sql(number)} type,
      row_number() over (partition by campus, {_asked_sql(number)} order by student_no) r from {seekers}),
    b{number} as (select *, row_number() over (partition by campus, type order by room_no, bed) r from {beds}),
    m{number} as (select s.student_id, s.student_no, s.campus, b.room_id, b.room_no, b.bed from s{number} s
      left join b{number} b on b.campus = s.campus and b.type = s.type and b.r = s.r),
    f{number} as (select campus, type, room_no, room_id, bed from b{number} anti join m{number} using (room_no, bed))"""


_HOUSING_SQL = f"""with beds as (select campus, type, room_no, room_id, unnest(range(1, capacity + 1)) bed from {S.ROOMS.sql} where capacity > 0),
    {_round_sql(1, S.STUDENTS.sql, 'beds')},
    {_round_sql(2, f"(select * from m1 where room_id is null and campus = '{RETRY_CAMPUS}')", 'f1')},
    {_round_sql(3, "(select * from m2 where room_id is null)", 'f2')},
    allocated as (select student_id, campus, room_id housing from m1 where room_id is not null
      union all select student_id, campus, '{V.HOUSING_PENDING}' from m1 where room_id is null and campus <> '{RETRY_CAMPUS}'
      union all select student_id, campus, room_id from m2 where room_id is not null
      union all select student_id, campus, coalesce(room_id, '{V.HOUSING_EXTERNAL}') from m3)"""


@catalog.add("housing_allocation", f"{_HOUSING_SQL} select * from allocated")
def _(spark, folder):
    return plain(allocation(spark, folder).drop("student_no"))


@catalog.add(
    "housing_occupancy",
    f"""{_HOUSING_SQL} select room_id, r.campus, type, {big('capacity')} capacity, n occupants, {big('capacity - n')} "left",
    case when n = 0 then '{V.ROOM_STATUSES[0]}' when n < capacity then '{V.ROOM_STATUSES[1]}' else '{V.ROOM_STATUSES[2]}' end status
    from (select r.*, (select count(*) from allocated where housing = r.room_id) n from {S.ROOMS.sql} r) r""",
)
def _(spark, folder):
    return plain(U.room_occupancy(rooms(spark, folder), allocation(spark, folder)))


# --- pages ----------------------------------------------------------------------------------------


@catalog.add(
    "students_page",
    f"""select student_id, last_name, first_name from {S.STUDENTS.sql} where college = 'CBAS'
    order by last_name, first_name, student_id limit 10 offset 10""",
)
def _(spark, folder):
    rows = U.students_page(students(spark, folder), 2, college="CBAS")
    return plain(rows.select("student_id", "last_name", "first_name"))


@catalog.add(
    "students_totals",
    f"""select count(*) total_items, (count(*) + 9) // 10 total_pages from {S.STUDENTS.sql} where enrollment_year = 2022""",
)
def _(spark, folder):
    return plain(U.students_totals(students(spark, folder), year=2022))


@catalog.add(
    "students_after",
    f"""select student_id, last_name, first_name from {S.STUDENTS.sql} where (last_name, first_name, student_id) > ('L20', 'F31', 'S5')
    order by last_name, first_name, student_id limit 15""",
)
def _(spark, folder):
    """The page that follows a given last row, however deep it lies."""
    rows = page_after(students(spark, folder), ["last_name", "first_name", "student_id"], ["L20", "F31", "S5"], 15)
    return plain(rows.select("student_id", "last_name", "first_name"))


@catalog.add(
    "rooms_page",
    f"""select room_id, {big('rent')} rent, status from {S.ROOMS.sql} where status = '{V.ROOM_STATUSES[1]}' order by rent, room_id limit 20""",
)
def _(spark, folder):
    return plain(U.rooms_page(rooms(spark, folder), status=V.ROOM_STATUSES[1]).select("room_id", "rent", "status"))


@catalog.add("rooms_totals", f"select count(*) total_items, (count(*) + 19) // 20 total_pages from {S.ROOMS.sql}")
def _(spark, folder):
    return plain(page_totals(rooms(spark, folder), 20))


@catalog.add(
    "student_lookup",
    f"select student_id, first_name || ' ' || last_name full_name, email from {S.STUDENTS.sql} where student_id = 'S42'",
)
def _(spark, folder):
    found = U.find_student(students(spark, folder), "S42", "customer#000000042@example.com")
    return plain(found.select("student_id", full_name("first_name", "last_name").alias("full_name"), "email"))


@catalog.add(
    "transcript_page",
    f"""select t.kind, {big('t.pos')} pos, t.course course_id, title course_name, g.entry.grade course_grade, {dbl('g.entry.grade_point')} course_grade_point
    from {_TRANSCRIPT_SQL} t join {S.COURSES.sql} c on c.course_code = t.course
    join (select course, min(struct_pack(grade, grade_point)) entry from {_TRANSCRIPT_SQL} where student_id = 'S7' group by course) g on g.course = t.course
    where student_id = 'S7'""",
)
def _(spark, folder):
    return plain(
        U.transcript_page("S7", graded_rows(spark, folder), courses(spark, folder), transcript(spark, folder))
    )
