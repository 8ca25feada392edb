import streamlit as st

st.title("Race Results")
st.markdown("""
Results by season.
""")

db, schema = "a", "b"
st.subheader("Winners")
df = session.sql(f"""
    SELECT driver, count(*)
    FROM {db}.{schema}.INT_RACE
    JOIN dims.Drivers USING (id)
    GROUP BY 1
""").to_pandas()
st.bar_chart(df)
st.caption("Per driver")


def other():
    q = "SELECT a FROM t1, t2, t3 WHERE x = 1"
    st.header("Tables")
    st.table(session.sql(q))


def no_tables():
    return "SELECT 1 -- no FROM here"
