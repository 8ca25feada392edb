import streamlit as st
st.table(session.sql("SELECT x FROM q_table WHERE x = 'a'"))
st.line_chart(1)
