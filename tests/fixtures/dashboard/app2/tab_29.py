import streamlit as st
tabs = st.tabs(["One", "Two"])
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
x = 1
with tabs[1]:
    q = "SELECT * FROM tab_table"
    st.dataframe(q)
