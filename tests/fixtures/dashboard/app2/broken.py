import streamlit as st
st.title("Broken")
q = "SELECT * FROM nope_table" +
