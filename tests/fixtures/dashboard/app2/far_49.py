import streamlit as st
q = "SELECT * FROM far_table"
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
st.metric(q)
