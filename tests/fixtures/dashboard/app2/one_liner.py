import streamlit as st
st.table("SELECT * FROM one_table")
y = 2
